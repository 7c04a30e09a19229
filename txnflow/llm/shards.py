"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0 to n-1 in order of their id. A keyed permutation of these numbers gives every row its place in the
shuffled order; the shard is ``place % shards`` and the slot in it ``place div shards``, so shard sizes differ by
one at most and slots have no gaps. Given n and the seed, place, shard and slot of any row number follow by arithmetic, and
:meth:`Feistel.row_at` goes back from (shard, slot) to the row number.

The permutation works on pairs (l, r) with 0 <= l < a and 0 <= r < b, a*b just above n, adding a keyed hash of one half
to the other modulo its range; each round can be undone, so it is one-to-one. Values of n and more are permuted
again until they fall below n (cycle walking). There are fewer than a of them, about the square root of n, so the longest
walk is found exactly in advance and written as that many conditional steps: no row is left over.

Defined results: null ids come last; a null text has no bytes, so size 1 and checksum 0; repeated rows are separate rows with
places of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import text_or_empty
from txnflow.operators.numbering import with_row_index

ROUNDS = 6


@dataclass(frozen=True)
class Feistel:
    """A permutation of 0 .. n-1 chosen by ``seed``; the same on the driver and as column expressions."""

    n: int
    seed: int = 0

    @property
    def a(self) -> int:
        return max(1, math.isqrt(max(0, self.n - 1)) + 1)

    @property
    def b(self) -> int:
        return max(1, -(-self.n // self.a))

    def _hash(self, turn: int, half: int) -> int:
        return int(hashlib.md5(f"{self.seed}:{turn}:{half}".encode()).hexdigest()[:8], 16)

    def once(self, x: int) -> int:
        l, r = divmod(x, self.b)
        for turn in range(ROUNDS):
            if turn % 2:
                r = (r + self._hash(turn, l)) % self.b
            else:
                l = (l + self._hash(turn, r)) % self.a
        return l * self.b + r

    def back_once(self, x: int) -> int:
        l, r = divmod(x, self.b)
        for turn in reversed(range(ROUNDS)):
            if turn % 2:
                r = (r - self._hash(turn, l)) % self.b
            else:
                l = (l - self._hash(turn, r)) % self.a
        return l * self.b + r

    def place(self, row: int) -> int:
        x = self.once(row)
        while x >= self.n:
            x = self.once(x)
        return x

    def row_of(self, place: int) -> int:
        x = self.back_once(place)
        while x >= self.n:
            x = self.back_once(x)
        return x

    def row_at(self, shard: int, slot: int, shards: int) -> int:
        return self.row_of(slot * shards + shard)

    def longest_walk(self) -> int:
        """Most steps that a value from n on takes to fall below n.

        Values that only lead to each other are never met on the way from a row number; when they alone are
        left, no walk ends any more.
        """
        steps, walkers = 0, list(range(self.n, self.a * self.b)) if self.n else []
        while walkers:
            moved = [y for y in map(self.once, walkers) if y >= self.n]
            if len(moved) == len(walkers):
                break
            steps, walkers = steps + 1, moved
        return steps

    def _hash_column(self, turn: int, half: Column) -> Column:
        digest = F.md5(F.concat(F.lit(f"{self.seed}:{turn}:"), half.cast("string")))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")

    def _once_columns(self, rows: DataFrame, x: str) -> DataFrame:
        rows = rows.withColumns({"_l": F.expr(f"{x} div {self.b}"), "_r": F.col(x) % self.b})
        for turn in range(ROUNDS):
            if turn % 2:
                rows = rows.withColumn("_r", (F.col("_r") + self._hash_column(turn, F.col("_l"))) % self.b)
            else:
                rows = rows.withColumn("_l", (F.col("_l") + self._hash_column(turn, F.col("_r"))) % self.a)
        return rows.withColumn("_next", F.col("_l") * self.b + F.col("_r")).drop("_l", "_r")

    def with_place(self, rows: DataFrame, row_index: str = "row_index") -> DataFrame:
        """``rows`` with ``place``."""
        rows = self._once_columns(rows, row_index).withColumnRenamed("_next", "place")
        for _ in range(self.longest_walk()):
            rows = self._once_columns(rows, "place")
            rows = rows.withColumn("place", F.when(F.col("place") < self.n, F.col("place")).otherwise(F.col("_next"))).drop("_next")
        return rows


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 0, id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, row_index, place, shard, slot``: law ``rows``."""
    narrow = docs.select(
        F.col(id_column).alias("doc_id"), F.col(id_column).isNull().alias("_last"),
        (F.octet_length(text_or_empty(text_column)) + 1).cast("bigint").alias("size"),
        F.crc32(text_or_empty(text_column).cast("binary")).alias("text_crc32"),
    )
    # Staged once by the numbering: the text is read a single time, and equal ids are spread over tasks.
    numbered = with_row_index(narrow, ("_last", "doc_id", "size", "text_crc32"))
    placed = Feistel(numbered.count(), seed).with_place(numbered)
    return placed.select(
        "doc_id", "size", "text_crc32", "row_index", "place",
        (F.col("place") % shards).cast("int").alias("shard"), F.expr(f"place div {int(shards)}").alias("slot"),
    )
