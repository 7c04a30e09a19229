"""SimHash near-duplicates, found by deletion-variant signatures.

A fingerprint has 64 bits. Two that differ in at most three have, of their two halves, one that differs in
at most one bit. So each half is indexed under 32 keys, in each of which one bit is a wildcard; fingerprints that
share a key are joined by equality and their distance is verified. Every link is found, and by one key only.

* Only different fingerprints are indexed: documents with equal ones are linked by being equal, however many.
* Keys that a single fingerprint has are dropped in the shuffle that groups them, before anything is joined.
* A key with more than ``crowded`` fingerprints is cut again by the same rule: its members differ in the other half only and
  in the wildcard, so the other half is cut into two quarters, each again under 16 one-wildcard keys.

``near_duplicates`` labels documents, ``keep_one`` keeps one of each group.

Defined results: null and empty texts have fingerprint zero and are linked like any other; texts are read whole; rows that repeat
id and text are one document; null ids rank last, and of rows with equal ids the one whose text hash is least comes first; an empty table gives an
empty result; other columns are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.llm.common import ship_package, slices, text_or_empty
from txnflow.llm.components import components
from txnflow.session import stage, temporary_stages

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
LOW_HALF = 0xFFFFFFFF
LARGEST = (1 << 63) - 1


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(LOWER).split()


def shingles(words: list[bytes], k: int) -> list[bytes]:
    """Runs of ``k`` words joined by a space; fewer words give one run, none give none."""
    if len(words) <= k:
        return [b" ".join(words)] if words else []
    if k == 1:
        return words
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def hashes(items: list[bytes], seed: int = 42) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x, seed) for x in items), np.uint64, len(items))


def majority(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each text: the bits set in over half of its hashes. ``counts``: hashes of each text, in order."""
    out = np.zeros(len(counts), np.uint64)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    n = counts[filled]
    # Bytes of one word count eight bits at a time, in runs of up to 255 so that no byte overflows.
    runs = -(-n // 255)
    run_of = np.repeat(np.arange(len(n)), runs)
    step = np.arange(len(run_of)) - np.repeat(np.cumsum(runs) - runs, runs)
    starts = (np.cumsum(n) - n)[run_of] + 255 * step
    texts = np.cumsum(runs) - runs
    result = np.zeros(len(n), np.uint64)
    for i in range(8):
        lanes = np.add.reduceat((values >> np.uint64(i)) & np.uint64(0x0101010101010101), starts)
        set_bits = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), texts, axis=0)
        for lane in range(8):
            result |= (2 * set_bits[:, lane] > n).astype(np.uint64) << np.uint64(8 * lane + i)
    out[filled] = result
    return out


def fingerprints(docs: DataFrame, words: int, id_column: str = "doc_id", text_column: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, fp`` and the whole numbers ``keep``: the fingerprint of the ``words``-word shingles of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            items = [hashes(shingles(words_of(text), words)) for text in batch.column(1).to_pylist()]
            counts = np.fromiter(map(len, items), np.int64, len(items))
            prints = majority(np.concatenate(items), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]], names=["doc_id", "fp", *keep])

    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_or_empty(text_column).alias("text"), *keep)
    return docs.mapInArrow(run, ", ".join(f"{c} bigint" for c in ("doc_id", "fp", *keep)))


def _bits(value: Column) -> Column:
    return F.bit_count(value).cast("int")


def _half(value: Column, low: bool) -> Column:
    return value.bitwiseAND(F.lit(LOW_HALF)) if low else F.shiftrightunsigned(value, 32)


def _without(value: Column, bit: Column) -> Column:
    """``value`` with one bit cleared."""
    return value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)))


def variants(prints: DataFrame) -> DataFrame:
    """``view, fp, v, key``: 64 one-wildcard keys of each fingerprint; v is the half (32) and the cleared bit."""
    rows = prints.select("view", "fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
    half = F.when(F.col("v") < 32, _half(F.col("fp"), True)).otherwise(_half(F.col("fp"), False))
    return rows.withColumn("key", _without(half, F.col("v") % 32))


def _pairs(rows: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """Pairs that share ``keys`` and are close, each under the first of its keys only."""
    left = rows.select(*keys, F.col("fp").alias("a"))
    right = rows.select(*[F.col(k).alias(f"r_{k}") for k in keys], F.col("fp").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    low, high = _bits(_half(differing, True)), _bits(_half(differing, False))
    in_half = F.when(F.col("v") < 32, low).otherwise(high)
    # The low half comes first; of a half without a difference all 32 keys agree, and the first counts.
    first = ((F.col("v") < 32) | (low > 1)) & ((in_half == 1) | (F.col("v") % 32 == 0))
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(k) == F.col(f"r_{k}"))
    return left.join(right, match & (F.col("a") < F.col("b")) & (_bits(differing) <= bits) & first)


def links(prints: DataFrame, bits: int = 3, crowded: int = 2000) -> DataFrame:
    """``view, a, b``: all pairs of different fingerprints of a view (``view``, ``fp``) within ``bits``."""
    if bits > 3:
        raise ValueError("two halves with one wildcard find up to three differing bits")
    same_key = Window.partitionBy("view", "v", "key")
    shared = stage(variants(prints).withColumn("n", F.count(F.lit(1)).over(same_key)).where(F.col("n") > 1), "shared-keys")
    found = _pairs(shared.where(F.col("n") <= crowded), ("view", "v", "key"), bits).select("view", "a", "b")
    if shared.where(F.col("n") > crowded).isEmpty():
        return found
    # The members of a crowded key agree in one half but for the wildcard: three differing bits at most lie in the other.
    rows = shared.where(F.col("n") > crowded).withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(31))))
    other = F.when(F.col("v") < 32, _half(F.col("fp"), False)).otherwise(_half(F.col("fp"), True))
    quarter = F.when(F.col("w") < 16, other.bitwiseAND(F.lit(0xFFFF))).otherwise(F.shiftrightunsigned(other, 16))
    rows = rows.withColumn("inner", _without(quarter, F.col("w") % 16))
    cut = _pairs(rows, ("view", "v", "key", "w", "inner"), bits).select("view", "a", "b").distinct()
    return found.unionByName(cut)


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row: fingerprints within ``bits`` are linked."""
    found = stage(fingerprints(docs, words, id_column, text_column), "prints")
    classes = stage(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "print-classes")
    linked = links(classes.select(F.lit(0).alias("view"), "fp"), bits).select(F.col("a").alias("u"), F.col("b").alias("v"))
    joined = components(linked).withColumnRenamed("node", "fp").join(classes, "fp")
    whole = joined.groupBy("root").agg(F.min("least").alias("component_least"))
    named = joined.join(whole, "root").select("fp", "component_least")
    labelled = classes.join(named, "fp", "left").select(
        F.col("fp").alias("class_fp"), F.coalesce("component_least", "least").alias("component_id"))
    return found.join(labelled, F.col("fp") == F.col("class_fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, bits: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` but those whose group of linked fingerprints has a document that ranks before: all columns as they are."""
    spark = docs.sparkSession
    text = text_or_empty(text_column)
    key = {"id": F.coalesce(F.col(id_column).cast("bigint"), F.lit(LARGEST)), "hash": F.xxhash64(text)}
    node = F.struct("id", "hash")
    with temporary_stages(spark) as scope:
        found = stage(fingerprints(docs.select(*[c.alias(n) for n, c in key.items()], text.alias("text")), words, "id", "text", keep=("hash",))
                      .withColumnRenamed("doc_id", "id"), "prints")
        classes = stage(found.groupBy("fp").agg(F.min(node).alias("least")), "print-classes")
        linked = links(classes.select(F.lit(0).alias("view"), "fp"), bits).select(F.col("a").alias("u"), F.col("b").alias("v"))
        joined = stage(components(linked).withColumnRenamed("node", "fp").join(classes, "fp"), "joined")
        whole = joined.groupBy("root").agg(F.min("least").alias("keep"))
        named = joined.join(whole, "root").select("fp", "keep")
        labelled = classes.join(named, "fp", "left").select(F.col("fp").alias("class_fp"), F.coalesce("keep", "least").alias("keep"))
        gone = found.join(labelled, F.col("fp") == F.col("class_fp")).where(node != F.col("keep")).select(
            F.col("id").alias("gone_id"), F.col("hash").alias("gone_hash"))
        dropped = scope.result(gone, "near-copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in key.items()])
    return rows.join(dropped, (F.col("id") == F.col("gone_id")) & (F.col("hash") == F.col("gone_hash")), "left_anti").select("row.*")
