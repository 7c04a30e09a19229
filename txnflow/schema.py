"""Record schemas and the conformance step that replaces schema inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.functions.numbers import lenient_double, lenient_int

RAW = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "invoice", "stockcode", "description", "quantity",
        "invoicedate", "price", "customer_id", "country",
    )
])

# One clean sale line. invoice_date is business time without a zone.
CLEAN = T.StructType([
    T.StructField("invoice", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("quantity_category", T.StringType()),
    T.StructField("high_value_customer", T.IntegerType()),
])

# The published record: a clean line plus its publish time, an instant.
RECORD = T.StructType([*CLEAN.fields, T.StructField("timestamp", T.TimestampType())])

# The same record as JSON or CSV text carries it.
WIRE = T.StructType([
    T.StructField(f.name, T.StringType()) if "timestamp" in f.dataType.typeName() else f
    for f in RECORD.fields
])

REQUEST = T.StructType([
    T.StructField("quantity", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
])


def _cast(df: DataFrame, field: T.StructField) -> Column:
    column = F.col(field.name)
    if df.schema[field.name].dataType == field.dataType:
        return column
    if isinstance(field.dataType, T.DoubleType):
        return lenient_double(df, field.name)
    if isinstance(field.dataType, T.IntegerType):
        return lenient_int(df, field.name)
    return column.try_cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` onto ``schema``: lenient casts, typed nulls for absent columns."""
    return df.select(
        *[
            (_cast(df, f) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ],
        *keep,
    )


def cast_present(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns of ``schema`` that exist and leave every other column alone."""
    wanted = {f.name: f for f in schema.fields}
    return df.select(*[
        _cast(df, wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns
    ])


def conformance_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column of ``schema``: present, null count, and values lost by the cast.

    One aggregate pass over ``df``; the result has one row per schema column.
    """
    measures = []
    for f in schema.fields:
        if f.name not in df.columns:
            measures.append(F.struct(
                F.lit(f.name).alias("column_name"), F.lit(False).alias("present"),
                F.count(F.lit(1)).alias("null_count"), F.lit(0).cast("long").alias("bad_count"),
            ))
            continue
        source, value = F.col(f.name), _cast(df, f)
        measures.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(True).alias("present"),
            F.count_if(source.isNull()).alias("null_count"),
            F.count_if(source.isNotNull() & value.isNull()).alias("bad_count"),
        ))
    return df.agg(F.array(*measures).alias("report")).select(F.inline("report"))
