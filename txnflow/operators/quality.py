"""Reports on what cleaning drops and what parsing loses; one aggregate each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.config import DEFAULTS, Settings
from txnflow.functions.numbers import is_number, lenient_double
from txnflow.functions.text import is_cancelled
from txnflow.functions.times import parse_time


def first_failed_rule(raw: DataFrame, settings: Settings = DEFAULTS) -> Column:
    """Name of the first cleaning rule a raw line breaks, ``kept`` if none."""
    quantity, price = lenient_double(raw, "quantity"), lenient_double(raw, "price")
    return (
        F.when(is_cancelled(F.col("invoice"), settings.ignore_invoice_case), "cancelled")
        .when(F.col("customer_id").isNull(), "missing_customer")
        .when(F.col("quantity").isNull() | F.col("price").isNull(), "missing_number")
        .when(~is_number(quantity) | ~is_number(price), "not_a_number")
        .when(~(quantity > 0), "quantity_not_positive")
        .when(~(price > 0), "price_not_positive")
        .otherwise("kept")
    )


def reject_reasons(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return (
        raw.groupBy(first_failed_rule(raw, settings).alias("reason"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def numeric_parse_report(raw: DataFrame, columns: tuple[str, ...] = ("quantity", "price")) -> DataFrame:
    """Per column: missing, unreadable, NaN and good values."""
    measures = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count_if(F.col(name).isNull()).alias("missing"),
            F.count_if(F.col(name).isNotNull() & lenient_double(raw, name).isNull()).alias("unreadable"),
            F.count_if(F.coalesce(F.isnan(lenient_double(raw, name)), F.lit(False))).alias("nan"),
            F.count_if(is_number(lenient_double(raw, name))).alias("good"),
        )
        for name in columns
    ]
    return raw.agg(F.array(*measures).alias("report")).select(F.inline("report"))


def time_parse_report(raw: DataFrame, column: str = "invoicedate", settings: Settings = DEFAULTS) -> DataFrame:
    """Counts of missing, unreadable and good times of a text column."""
    time = parse_time(F.col(column), settings.time_formats)
    return raw.agg(
        F.count_if(F.col(column).isNull()).alias("missing"),
        F.count_if(F.col(column).isNotNull() & time.isNull()).alias("unreadable"),
        F.count_if(time.isNotNull()).alias("good"),
    )


def cancelled_by_mode(raw: DataFrame) -> DataFrame:
    """Cancelled lines under both readings of the prefix test."""
    return raw.agg(
        F.count_if(is_cancelled(F.col("invoice"), True)).alias("any_case"),
        F.count_if(is_cancelled(F.col("invoice"), False)).alias("lower_case_only"),
        F.count(F.lit(1)).alias("lines"),
    )
