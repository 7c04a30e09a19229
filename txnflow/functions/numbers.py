"""Lenient number parsing and small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_double(text: Column) -> Column:
    """Text to double, null when it is not a plain decimal number, NaN or infinity.

    Java also reads a d or f suffix and hexadecimal floats, which no sales file means.
    String tests keep this far cheaper than a regular expression.
    """
    low = F.lower(F.rtrim(text))
    java_only = low.endswith("d") | low.contains("x") | (low.endswith("f") & ~low.endswith("inf"))
    return F.when(~java_only, text.try_cast("double"))


def lenient_double(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_double(F.col(name))
    return F.col(name).try_cast("double")


def lenient_int(df: DataFrame, name: str) -> Column:
    """Whole numbers, also from text such as ``12.0``."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_double(F.col(name)).try_cast("int")
    return F.col(name).try_cast("int")


def nan_to_null(value: Column) -> Column:
    """Spark orders NaN above every number, so a comparison alone would let it pass."""
    return F.nanvl(value, F.lit(None).cast("double"))


def is_number(value: Column) -> Column:
    """True for values that are neither null nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))
