"""Train/test split by row hash: the same rows whatever the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.config import DEFAULTS
from txnflow.functions.keys import unit_hash

TRAIN, TEST = "train", "test"


def with_split(df: DataFrame, keys: Sequence[str] | None = None, fraction: float = DEFAULTS.train_fraction,
               seed: int = DEFAULTS.seed, portable: bool = False) -> DataFrame:
    """Add ``split``. Without keys every column counts, so copies of a row stay together."""
    share = unit_hash(list(keys or df.columns), seed, portable)
    return df.withColumn("split", F.when(share < F.lit(fraction), TRAIN).otherwise(TEST))


def count_by_split(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("lines"))
