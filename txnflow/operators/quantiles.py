"""Exact quantiles of any orderable column without a global sort or a single big group."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.session import stage

# A range is narrowed until it has no more rows than this, whatever the size of the data; the ranks are then
# read off one sorted table of so many values at most.
SMALL = 4_096
ACCURACY = 10_000


@dataclass
class _Range:
    """An open value range; values travel as text and are cast back, which is exact."""

    low: str | None
    high: str | None
    before: int
    rows: int

    def rows_of(self, values: DataFrame, kind: str) -> DataFrame:
        inside = values
        if self.low is not None:
            inside = inside.where(F.col("v") > F.lit(self.low).cast(kind))
        if self.high is not None:
            inside = inside.where(F.col("v") < F.lit(self.high).cast(kind))
        return inside


def _read_ranks(values: DataFrame, ranks: Sequence[int]) -> list[str]:
    counted = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    upto = counted.select("v", F.sum("n").over(Window.orderBy("v")).alias("upto"))
    row = upto.agg(*[
        F.min(F.when(F.col("upto") > rank, F.col("v"))).cast("string").alias(f"r{i}")
        for i, rank in enumerate(ranks)
    ]).first()
    return list(row)


def _narrow(values: DataFrame, kind: str, span: _Range, ranks: Sequence[int], accuracy: int) -> list[str | _Range]:
    """Cut the range at two pivots around each rank, for all ranks in the same two passes; the value itself or a smaller range for each."""
    inside = span.rows_of(values, kind)
    margin = 2.0 / accuracy
    shares = [(rank - span.before) / span.rows for rank in ranks]
    pivots = inside.agg(
        F.percentile_approx("v", [p for share in shares for p in (max(0.0, share - margin), min(1.0, share + margin))], accuracy).alias("p")
    ).select(*[F.element_at("p", i + 1).cast("string") for i in range(2 * len(ranks))]).first()
    counts = inside.agg(*[
        count for p in pivots for count in (F.count_if(F.col("v") < F.lit(p).cast(kind)), F.count_if(F.col("v") <= F.lit(p).cast(kind)))]).first()
    return [_part(span, rank, pivots[2 * i:2 * i + 2], counts[4 * i:4 * i + 4]) for i, rank in enumerate(ranks)]


def _part(span: _Range, rank: int, pivots: Sequence[str], counts: Sequence[int]) -> str | _Range:
    """Where in a range that is cut at two pivots a rank lies."""
    first, second = pivots
    below_a, upto_a, below_b, upto_b = counts
    place = rank - span.before
    if place < below_a:
        return _Range(span.low, first, span.before, below_a)
    if place < upto_a:
        return first
    if place < below_b:
        return _Range(first, second, span.before + upto_a, below_b - upto_a)
    if place < upto_b:
        return second
    return _Range(second, span.high, span.before + upto_b, span.rows - upto_b)


def _values_at(df: DataFrame, column: str, ranks_of, small: int, accuracy: int) -> tuple[list[str], str]:
    """Values at 0-based ranks, as text, with the column's type."""
    kind = df.schema[column].dataType.simpleString()
    value = F.col(column)
    if kind == "timestamp":
        # Microseconds: as text, an hour that a clock change repeats would name two instants.
        kind, value = "bigint", F.unix_micros(value)
    # Staged, since every pass reads it: what makes the values runs once.
    values = stage(df.select(value.alias("v")).where(F.col("v").isNotNull()), "values")
    total = values.count()
    if not total:
        return [], kind
    ranks = ranks_of(total)
    whole = _Range(None, None, 0, total)
    # The passes over all values serve all ranks; what is left after them is a small share of the rows.
    spans = _narrow(values, kind, whole, ranks, accuracy) if total > small else [whole] * len(ranks)
    found = []
    for rank, span in zip(ranks, spans, strict=True):
        while isinstance(span, _Range) and span.rows > small:
            span = _narrow(values, kind, span, [rank], accuracy)[0]
        if isinstance(span, _Range):
            span = _read_ranks(span.rows_of(values, kind), [rank - span.before])[0]
        found.append(span)
    return found, kind


def quantiles_disc(df: DataFrame, column: str, fractions: Sequence[Fraction | float],
                   small: int = SMALL, accuracy: int = ACCURACY) -> list[Column] | None:
    """For each fraction the smallest value that at least this share of rows does not exceed.

    Results are typed literals, so a filter on them reaches the scan. None without values.
    Each narrowing reads one column and leaves about 4/``accuracy`` of the rows.
    """
    found, kind = _values_at(
        df, column, lambda n: [max(1, ceil(Fraction(f) * n)) - 1 for f in fractions], small, accuracy
    )
    literals = [F.lit(v).cast(kind) for v in found]
    if df.schema[column].dataType.typeName() == "timestamp":
        literals = [F.timestamp_micros(v) for v in literals]
    return literals or None


def quantile_cont(df: DataFrame, column: str, fraction: float,
                  small: int = SMALL, accuracy: int = ACCURACY) -> float | None:
    """Quantile of a numeric column, interpolated between the two nearest ranks."""
    spot: list[float] = []

    def ranks(n: int) -> list[int]:
        spot.append(fraction * (n - 1))
        return [floor(spot[0]), ceil(spot[0])]

    found, _ = _values_at(df, column, ranks, small, accuracy)
    if not found:
        return None
    low, high = (float(v) for v in found)
    return low + (high - low) * (spot[0] - floor(spot[0]))
