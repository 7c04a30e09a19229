"""Union and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name; tables whose column names differ raise an error."""
    if not tables:
        raise ValueError("nothing to union")
    return reduce(lambda left, right: left.unionByName(right), tables)


def _as_text(field: T.StructField) -> Column | None:
    """A value as text that no other value has; None for nested values."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(value)
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(field.dataType, (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)):
        return value.cast("string")
    return None


def with_digest(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame | None:
    """Add the SHA-256 of the values of ``keys``, nulls told apart from texts; None if a value is nested."""
    texts = [_as_text(df.schema[key]) for key in keys]
    if any(text is None for text in texts):
        return None
    whole = F.to_json(F.struct(*[text.alias(f"c{place}") for place, text in enumerate(texts)]))
    return df.withColumn(name, F.unhex(F.sha2(whole, 256)))


def distinct_rows(df: DataFrame, ignoring: Sequence[str] = (), watermark: str | None = None,
                  event_time: str = "timestamp", salts: int = 16) -> DataFrame:
    """Distinct rows, optionally on all columns but ``ignoring`` (say, the publish time).

    Copies collapse map-side before the shuffle, so a large group of copies costs one
    row per task. A stream needs a ``watermark`` delay on ``event_time`` to bound its state;
    it has no map-side step, so copies first collapse in ``salts`` groups and only what is left meets
    under its key. The group comes from the ``ignoring`` columns, in which copies differ (the publish time, a source
    offset): it travels with the record and is the same in a replay. The state holds a SHA-256 of the keys, 32 bytes a row however wide it is.
    """
    keys = [c for c in df.columns if c not in set(ignoring)]
    if df.isStreaming:
        if not watermark:
            raise ValueError("duplicate removal on a stream needs a watermark delay")
        timed = df.withWatermark(event_time, watermark)
        digested = with_digest(timed, keys, "_digest")
        if digested is not None:
            timed, keys = digested, ["_digest"]
        if ignoring:
            salted = timed.withColumn("_salt", F.pmod(F.xxhash64(*ignoring), F.lit(salts)))
            timed = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
        return timed.dropDuplicatesWithinWatermark(keys).drop("_digest")
    return df.dropDuplicates(keys) if ignoring else df.distinct()


def union_distinct(tables: Sequence[DataFrame], ignoring: Sequence[str] = ()) -> DataFrame:
    return distinct_rows(union_all(tables), ignoring)
