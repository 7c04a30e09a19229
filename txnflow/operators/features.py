"""Preparation of training rows: time column, target, features, guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_time(df: DataFrame, source: str = "timestamp", name: str = "timestamp_col") -> DataFrame:
    """Timestamp column out of text; the current time when the source is absent."""
    if source not in df.columns:
        return df.withColumn(name, F.current_timestamp())
    if df.schema[source].dataType.typeName() == "string":
        return df.withColumn(name, F.try_to_timestamp(F.col(source)))
    return df.withColumn(name, F.col(source))


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def keep_present(df: DataFrame, columns: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """The listed columns that exist; an absent required one is an error."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"required columns missing: {', '.join(absent)}")
    return df.select(*present(df, columns))


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def fill_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Null features become 0.0; whole-number columns widen to double, NaN stays."""
    filled = set(present(df, features))
    return df.select(*[
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in filled else F.col(c)
        for c in df.columns
    ])


def prepare(df: DataFrame, target: str, features: Sequence[str],
            carry: Sequence[str] = ()) -> DataFrame:
    """Training rows: target, present features filled, and the carried columns only."""
    if target not in df.columns:
        raise ValueError(f"target column missing: {target}")
    usable = present(df, features)
    if not usable:
        raise ValueError(f"none of the feature columns exist: {', '.join(features)}")
    names = list(dict.fromkeys([target, *usable, *present(df, carry)]))
    return fill_features(drop_null_target(df.select(*names), target), usable)


def target_values(df: DataFrame, target: str) -> DataFrame:
    """Whether a target is binary: distinct values, rows outside {0, 1}, nulls."""
    column = F.col(target)
    return df.agg(
        F.count_if(column == 0).alias("zeros"),
        F.count_if(column == 1).alias("ones"),
        F.count_if(column.isNotNull() & ~column.isin(0, 1)).alias("other"),
        F.count_if(column.isNull()).alias("nulls"),
    ).withColumn("is_binary", F.col("other") == 0)
