"""Scalar building blocks, all native column expressions."""
