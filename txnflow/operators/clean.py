"""Cleaning and feature derivation of raw sale lines; works on streams too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.config import DEFAULTS, Settings
from txnflow.functions.bands import quantity_band
from txnflow.functions.numbers import lenient_double, nan_to_null
from txnflow.functions.text import is_cancelled
from txnflow.functions.times import calendar_part, parse_time
from txnflow.schema import CLEAN

REQUIRED = ("quantity", "price")


def _text(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def _time(df: DataFrame, settings: Settings) -> Column:
    if "invoicedate" not in df.columns:
        return F.lit(None).cast("timestamp_ntz")
    if df.schema["invoicedate"].dataType.typeName() == "string":
        return parse_time(F.col("invoicedate"), settings.time_formats)
    return F.col("invoicedate").cast("timestamp_ntz")


def clean(raw: DataFrame, settings: Settings = DEFAULTS,
          keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Valid sale lines with amount, calendar and band features.

    Dropped: cancelled invoices, lines without customer, and lines whose quantity or
    price is missing, not a number, or not positive. A line with an unreadable date
    stays, with calendar fields 0. Everything is a narrow projection over the scan.
    Without a quantity or price column the result is empty but typed. ``keep`` names
    further columns to carry along.
    """
    if not set(REQUIRED) <= set(raw.columns):
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in CLEAN.fields]
        return raw.select(*nothing, *keep).where(F.lit(False))

    kept = raw
    if "invoice" in raw.columns:
        kept = kept.where(~is_cancelled(F.col("invoice"), settings.ignore_invoice_case))
    if "customer_id" in raw.columns:
        kept = kept.where(F.col("customer_id").isNotNull())

    typed = kept.select(
        _text(raw, "invoice").alias("invoice"),
        _text(raw, "stockcode").alias("stock_code"),
        _text(raw, "description").alias("description"),
        nan_to_null(lenient_double(raw, "quantity")).alias("quantity"),
        _time(raw, settings).alias("invoice_date"),
        nan_to_null(lenient_double(raw, "price")).alias("price"),
        _text(raw, "customer_id").alias("customer_id"),
        _text(raw, "country").alias("country"),
        *keep,
    )
    quantity, price, time = F.col("quantity"), F.col("price"), F.col("invoice_date")
    return typed.where((quantity > 0) & (price > 0)).select(
        "invoice", "stock_code", "description", "quantity", "invoice_date", "price",
        "customer_id", "country",
        (quantity * price).alias("total_amount"),
        calendar_part(F.month(time)).alias("month"),
        calendar_part(F.dayofmonth(time)).alias("day"),
        calendar_part(F.hour(time)).alias("hour"),
        quantity_band(quantity).alias("quantity_category"),
        F.lit(0).alias("high_value_customer"),
        *keep,
    )
