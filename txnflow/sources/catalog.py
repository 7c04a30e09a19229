"""The catalog of saved batches, built from file listings or from a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnflow.functions.times import FILE_STAMP
from txnflow.sources.files import batch_files
from txnflow.sources.registry import MODEL_NAMES

BATCH_NAME = r"batch_(\d+)_(\d{8}_\d{6})\.csv"


def batch_file_name(batch_id: Column, saved_at: Column) -> Column:
    return F.concat(
        F.lit("batch_"), batch_id.cast("string"), F.lit("_"),
        F.date_format(saved_at, FILE_STAMP), F.lit(".csv"),
    )


def parse_batch_names(names: DataFrame, column: str = "value") -> DataFrame:
    """Batch id and save time out of file names; other names are dropped."""
    stamp = F.regexp_extract(column, BATCH_NAME, 2)
    return names.where(F.col(column).rlike(BATCH_NAME)).select(
        F.regexp_extract(column, BATCH_NAME, 1).try_cast("bigint").alias("batch_id"),
        F.try_to_timestamp(stamp, F.lit(FILE_STAMP)).cast("timestamp_ntz").alias("saved_at"),
        F.regexp_extract(column, BATCH_NAME, 0).alias("file_name"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Catalog from a text file that lists batch file names, one per line."""
    return parse_batch_names(spark.read.text(path))


def list_batches(spark: SparkSession, root: str) -> DataFrame:
    """Catalog from the files under ``root``: one row per batch, either layout.

    Only file status is used: the ``content`` column is pruned, so no file is opened.
    """
    files = batch_files(spark, root)
    named = F.try_to_timestamp(F.nullif(F.regexp_extract("path", BATCH_NAME, 2), F.lit("")), F.lit(FILE_STAMP))
    saved = F.coalesce(named, F.col("modificationTime")).cast("timestamp_ntz")
    return (
        files.groupBy("batch_id")
        .agg(F.max(saved).alias("saved_at"), F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .withColumn("file_name", batch_file_name(F.col("batch_id"), F.col("saved_at")))
    )


def batch_gaps(catalog: DataFrame, span: int = 100_000) -> DataFrame:
    """Seconds between each batch and the one before it, in numeric id order.

    The lag runs inside spans of ``span`` ids. What crosses a span comes from the
    last batch of the span before, a table ``span`` times smaller than the catalog.
    """
    spanned = catalog.withColumn("_span", F.expr(f"batch_id div {int(span)}"))
    last = spanned.groupBy("_span").agg(F.max_by("saved_at", "batch_id").alias("_last"))
    carried = last.select("_span", F.lag("_last").over(Window.orderBy("_span")).alias("_carried"))
    within = F.lag("saved_at").over(Window.partitionBy("_span").orderBy("batch_id"))
    return (
        spanned.withColumn("_within", within)
        .join(carried, "_span", "left")
        .withColumn("_previous", F.coalesce("_within", "_carried"))
        .withColumn(
            "gap_seconds",
            F.timestamp_diff("MICROSECOND", F.col("_previous"), F.col("saved_at")) / F.lit(1e6),
        )
        .drop("_span", "_within", "_carried", "_previous")
    )


def catalog_summary(catalog: DataFrame) -> DataFrame:
    """First, latest and number of batches in one aggregate.

    First means lowest id; latest means last saved, the higher id on a tie.
    """
    return catalog.agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.min_by("file_name", "batch_id").alias("first_batch"),
        F.max_by("file_name", F.struct("saved_at", "batch_id")).alias("latest_batch"),
    )


def batch_status(catalog: DataFrame, directory: str) -> DataFrame:
    """One status row: batch count, latest batch, folder, known models, time of asking."""
    return catalog_summary(catalog).select(
        "total_batches",
        "latest_batch",
        F.lit(directory).alias("batch_directory"),
        F.array(*[F.lit(name) for name in MODEL_NAMES]).alias("models_available"),
        F.current_timestamp().alias("timestamp"),
    )
