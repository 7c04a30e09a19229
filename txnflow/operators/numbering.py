"""Dense row numbers and running totals without a single-task window.

Rows are range-partitioned and sorted by Spark, then written once together with their
place (task, position in task). The place is a stored value from then on, so
counting tasks and using the counts see the same layout even if executors are lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnflow.config import DEFAULTS
from txnflow.session import stage

_IN_TASK_BITS = 33  # monotonically_increasing_id: task above, position below


def in_order(df: DataFrame, order_by: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """``df`` staged in order, with ``_task`` and ``_position``.

    Without ``order_by`` rows keep their arrival order. Unless the caller knows the keys
    to be ``unique``, the input is staged first and equal keys are ordered by their place
    in it: one key held by a third of the rows is then spread over many tasks.
    """
    ordered = df
    if order_by and unique:
        ordered = df.sort(*order_by)
    elif order_by:
        placed = stage(df, "input").withColumn("_arrival", F.monotonically_increasing_id())
        ordered = placed.sort(*order_by, F.xxhash64(*df.columns), "_arrival").drop("_arrival")
    staged = stage(ordered.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    return (
        staged.withColumn("_task", F.shiftright("_place", _IN_TASK_BITS))
        .withColumn("_position", F.col("_place").bitwiseAND(F.lit((1 << _IN_TASK_BITS) - 1)))
        .drop("_place")
    )


def before_each_task(placed: DataFrame, **totals) -> DataFrame:
    """Totals over all earlier tasks, one row per task.

    The window has no partition, but its input has as many rows as the sort had tasks.
    """
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = placed.groupBy("_task").agg(*[column.alias(name) for name, column in totals.items()])
    return per_task.select(
        "_task",
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in totals],
    )


def with_row_index(df: DataFrame, order_by: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """Add ``row_index``: 0, 1, 2, ... in the given order, or in arrival order."""
    placed = in_order(df, order_by, unique)
    starts = before_each_task(placed, _start=F.count(F.lit(1)))
    # One row per task of the sort: the broadcast does not grow with the rows.
    return (
        placed.join(F.broadcast(starts), "_task")
        .withColumn("row_index", F.col("_start") + F.col("_position"))
        .select(*df.columns, "row_index")
    )


def with_batch_id(df: DataFrame, size: int = DEFAULTS.batch_size, order_by: Sequence[str] = (),
                  unique: bool = False) -> DataFrame:
    """Add ``batch_id``: consecutive batches of exactly ``size`` rows, the last one shorter."""
    indexed = with_row_index(df, order_by, unique)
    # Whole-number division: a double would lose the last digits of large positions.
    return indexed.withColumn("batch_id", F.expr(f"row_index div {int(size)}")).drop("row_index")
