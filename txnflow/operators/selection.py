"""Training-set selection: cumulative thirds, time windows, batches, first batch."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.config import DEFAULTS
from txnflow.operators.quantiles import quantiles_disc


def with_fold(df: DataFrame, time: str, folds: int = 3) -> DataFrame:
    """Add ``fold`` 1..folds: equal shares of the rows in time order.

    Rows of one instant share a fold; rows without time join the last fold.
    """
    cuts = quantiles_disc(df, time, [Fraction(k, folds) for k in range(1, folds)])
    if cuts is None:
        return df.withColumn("fold", F.lit(folds))
    fold = F.when(F.col(time).isNull(), F.lit(folds))
    for number, cut in enumerate(cuts, start=1):
        fold = fold.when(F.col(time) <= cut, F.lit(number))
    return df.withColumn("fold", fold.otherwise(F.lit(folds)))


def first_folds(df: DataFrame, k: int) -> DataFrame:
    return df.where(F.col("fold") <= k)


def with_window(df: DataFrame, time: str, minutes: int = DEFAULTS.window_minutes) -> DataFrame:
    """Add ``window``: the number of ``minutes`` from the earliest row needed to reach this one.

    The first window holds its end, so a row exactly ``minutes`` after the earliest has
    window 1. Rows without time have none. The earliest time is a scalar subquery: a
    single aggregated value, no join.
    """
    begin = df.agg(F.min(time).alias("begin")).scalar()
    passed = F.timestamp_diff("MICROSECOND", begin, F.col(time))
    window = F.ceil(passed / F.lit(minutes * 60_000_000)).cast("int")
    return df.withColumn("window", F.when(F.col(time).isNotNull(), F.greatest(F.lit(1), window)))


def first_windows(df: DataFrame, k: int) -> DataFrame:
    return df.where(F.col("window") <= k)


def first_minutes(df: DataFrame, time: str, windows: int = 1,
                  minutes: int = DEFAULTS.window_minutes, begin: Column | None = None) -> DataFrame:
    """Rows up to ``windows * minutes`` minutes after the earliest one, both ends included.

    ``begin``, the earliest time where it is known already, saves looking for it in the rows.
    """
    begin = df.agg(F.min(time).alias("begin")).scalar() if begin is None else begin
    return df.where(F.col(time) <= begin + F.make_dt_interval(mins=F.lit(windows * minutes)))


def batch_ids(df: DataFrame, k: int) -> list[int]:
    """The ``k`` lowest batch ids, in numeric order."""
    lowest = df.select("batch_id").distinct().orderBy("batch_id").limit(k)
    return [row.batch_id for row in lowest.collect()]


def first_batches(df: DataFrame, k: int, cumulative: bool = True, ids: list[int] | None = None) -> DataFrame:
    """Rows of the first ``k`` batches, or of the k-th alone; ids are literals, so folders prune.

    ``ids`` in order, as a catalog of saved batches has them, saves looking for them in the rows.
    """
    ids = batch_ids(df, k) if ids is None else ids[:k]
    if len(ids) < k:
        raise ValueError(f"only {len(ids)} batches exist, {k} needed")
    return df.where(F.col("batch_id").isin(ids if cumulative else ids[-1:]))


def first_sorted_batches(df: DataFrame, k: int, size: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``k`` batches of ``size`` rows in an order that is unique, with ``batch_id``.

    Each task keeps its least ``k * size`` rows, so nothing else is sorted or moved: for batches of a size that fits a task.
    """
    first = df.orderBy(*order_by).limit(k * size)
    place = F.row_number().over(Window.orderBy(*order_by)) - 1
    return first.withColumn("batch_id", F.floor(place / F.lit(size)).cast("bigint"))


def first_batch_minimal(df: DataFrame) -> DataFrame:
    """The whole first batch."""
    return first_batches(df, 1)
