"""What is known of the saved batches without reading them again.

For each batch the ledger holds the spend and lines of every customer in it, and the first and last publish time. So the customer label
after one more batch needs the new batch and small tables, and a training set that is cut by time or by batch number opens only the
folders it needs.

A folder of the ledger holds a stretch of ``SEGMENT`` batch ids. Entering batches writes the folders they fall into anew, with the other batches there.

A record that was delivered twice counts once, in its first batch. Copies carry the same publish time, so a new batch is compared with those
earlier ones alone whose times overlap its own; records without a publish time are compared inside the batches that are recorded together.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.config import DEFAULTS, Settings
from txnflow.operators.label import label_customers
from txnflow.schema import RECORD
from txnflow.session import path_exists, stage, temporary_stages
from txnflow.sources.files import among, batch_files, read_batches

SPEND = "customer_id string, spend decimal(38,6), lines bigint, batch_id bigint"
RANGES = "first_time timestamp, last_time timestamp, rows bigint, batch_id bigint"

# Batches of one folder of the ledger: its files are far fewer than the batches, however many of these there are.
SEGMENT = 1000


def _table(spark: SparkSession, ledger: str, kind: str, schema: str) -> DataFrame:
    path = f"{ledger.rstrip('/')}/{kind}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _enter(spark: SparkSession, ledger: str, kind: str, schema: str, rows: DataFrame, ids: Sequence[int]) -> None:
    """Replace what is known of some batches by ``rows``."""
    segment = F.expr(f"batch_id div {SEGMENT}")
    touched = among(segment, {n // SEGMENT for n in ids})
    kept = _table(spark, ledger, kind, schema).where(touched & ~among(F.col("batch_id"), ids)).select(*rows.columns)
    # Staged, since the folders read here are written anew; each of them by one task.
    whole = stage(rows.unionByName(kept).withColumn("segment", segment).repartition("segment"), kind)
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("segment").parquet(f"{ledger.rstrip('/')}/{kind}")


def ranges(spark: SparkSession, ledger: str) -> DataFrame:
    """One row for each recorded batch."""
    return _table(spark, ledger, "ranges", RANGES)


def recorded_ids(spark: SparkSession, ledger: str, until: datetime | None = None) -> list[int]:
    """The recorded batches in order; with ``until`` those that begin no later, or have no times."""
    known = ranges(spark, ledger)
    if until is not None:
        known = known.where(F.col("first_time").isNull() | (F.col("first_time") <= F.lit(until)))
    return [r.batch_id for r in known.select("batch_id").orderBy("batch_id").collect()]


def first_copies(batches: DataFrame) -> DataFrame:
    """Distinct records with the first batch that has them."""
    return batches.groupBy(*RECORD.names).agg(F.min("batch_id").alias("batch_id"))


def record_batches(spark: SparkSession, root: str, ledger: str, ids: Sequence[int], settings: Settings = DEFAULTS) -> None:
    """Enter batches, each as a whole: entering one again replaces it."""
    if not ids:
        return
    with temporary_stages(spark):
        new = stage(read_batches(spark, root, settings.batch_format, ids=ids), "new-batches")
        times = stage(new.groupBy("batch_id").agg(
            F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"), F.count(F.lit(1)).alias("rows")), "times")
        whole = times.agg(F.min("first_time").alias("begin"), F.max("last_time").alias("end")).first()
        known = ranges(spark, ledger).where(~among(F.col("batch_id"), ids))
        near = [] if whole.begin is None else [
            r.batch_id for r in known.where((F.col("last_time") >= F.lit(whole.begin)) & (F.col("first_time") <= F.lit(whole.end))).collect()]
        compared = new
        if near:
            earlier = read_batches(spark, root, settings.batch_format, ids=near).where(F.col("timestamp") >= F.lit(whole.begin))
            compared = new.unionByName(earlier)
        fresh = first_copies(compared).where(among(F.col("batch_id"), ids))
        spend = fresh.where(F.col("customer_id").isNotNull()).groupBy("batch_id", "customer_id").agg(
            F.sum(F.col("total_amount").cast("decimal(28,6)")).cast("decimal(38,6)").alias("spend"), F.count(F.lit(1)).alias("lines"))
        _enter(spark, ledger, "spend", SPEND, spend, ids)
        _enter(spark, ledger, "ranges", RANGES, times, ids)


def record_missing(spark: SparkSession, root: str, ledger: str, settings: Settings = DEFAULTS) -> list[int]:
    """Enter the saved batches that are not recorded yet; their ids."""
    saved = batch_files(spark, root).select("batch_id").distinct()
    missing = [r.batch_id for r in saved.join(ranges(spark, ledger), "batch_id", "left_anti").orderBy("batch_id").collect()]
    record_batches(spark, root, ledger, missing, settings)
    return missing


def recorded_customers(spark: SparkSession, ledger: str, threshold: float | None = None,
                       quantile: float = DEFAULTS.high_value_quantile) -> DataFrame:
    """One labelled row per customer of all recorded batches, out of the spend tables alone."""
    spend = _table(spark, ledger, "spend", SPEND).groupBy("customer_id").agg(
        F.sum("spend").cast("double").alias("spend"), F.sum("lines").alias("lines"))
    return label_customers(spend, threshold, quantile)


def recorded_lines(spark: SparkSession, root: str, ids: Sequence[int], settings: Settings = DEFAULTS) -> DataFrame:
    """Distinct records of some batches; no other files are opened."""
    return first_copies(read_batches(spark, root, settings.batch_format, ids=ids))


def window_ids(spark: SparkSession, ledger: str, minutes: int) -> list[int]:
    """The batches that may hold records of the first ``minutes``."""
    begin = ranges(spark, ledger).agg(F.min("first_time").alias("begin")).first().begin
    return recorded_ids(spark, ledger, begin + timedelta(minutes=minutes)) if begin else recorded_ids(spark, ledger)
