"""Row keys and hash buckets that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def message_key(df: DataFrame, column: str = "customer_id") -> Column:
    """Publishing key: the customer, else a running number (batch) or row hash (stream)."""
    if df.isStreaming:
        fallback = F.hex(F.xxhash64(*df.columns))
    else:
        fallback = F.monotonically_increasing_id().cast("string")
    if column not in df.columns:
        return fallback
    return F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), fallback)


def unit_hash(columns: Sequence[str], seed: int, portable: bool = False) -> Column:
    """A number in [0, 1) that depends on the row's values and the seed only.

    ``portable`` takes md5, which other engines can repeat; the default is the
    much cheaper xxhash64.
    """
    if portable:
        digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    bits = F.xxhash64(F.lit(seed), *columns)
    return F.shiftrightunsigned(bits, 11).cast("double") / F.lit(float(2**53))
