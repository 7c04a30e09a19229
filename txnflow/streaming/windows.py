"""Event-time windows on a stream: counts and sums that are final once the watermark has passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.config import DEFAULTS


def window_totals(stream: DataFrame, time: str, amount: str, delay: str, minutes: int = DEFAULTS.window_minutes,
                  by: Sequence[str] = ()) -> DataFrame:
    """Rows and sum of ``amount`` of each window of ``minutes``, for each value of ``by``.

    A window is given once, when the latest event seen is ``delay`` past its end; events that come later than that are dropped, which
    bounds the state to the windows still open. Works on a batch too, where every window is given.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    if stream.isStreaming:
        timed = timed.withWatermark(time, delay)
    totals = timed.groupBy(F.window(time, f"{minutes} minutes").alias("window"), *by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(amount).alias("amount"))
    return totals.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "rows", "amount")
