"""Exact deduplication: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups.

Texts are equal when identical after each run of ASCII white space has become one space; null counts as empty.
Everything runs as DataFrame expressions.

* ``text_classes`` groups by (hash, normalised text). The hash decides where rows go; equality of the group key is a
  comparison of bytes, so texts that collide in the hash never share a class. Copies collapse before
  the shuffle: of a text that holds a third of all rows, each task sends one row.
* Documents then find their class by two digests, the 128-bit hash and the SHA-256 of the text: a collision of the hash
  leaves two classes, which the second digest tells apart. This join moves ids and digests only, and
  adaptive execution splits a text with very many copies.

Defined results: a null id ranks after all others; rows that repeat both id and text are one document stored
several times, of which one is kept; an empty table gives an empty result. Other columns are ignored or, in
:func:`keep_first`, carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import ASCII_SPACE, text_or_empty


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(text_or_empty(text), ASCII_SPACE, " ")


def content_hash(text: Column) -> Column:
    """128 bits as binary, half the size of the hexadecimal form."""
    return F.unhex(F.md5(text))


def text_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each distinct text: ``hash``, ``sha``, ``keep_id``, ``group_size``."""
    keyed = docs.select(F.col(id_column).alias("id"), normalised(text_column).alias("norm"))
    classes = (
        keyed.select("id", "norm", content_hash(F.col("norm")).alias("hash"))
        .groupBy("hash", "norm")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return classes.select("hash", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row, dropped ones too."""
    keyed = docs.select(F.col(id_column).alias("id"), normalised(text_column).alias("norm"))
    # Rows that repeat id and text collapse and are counted, so that exactly one of them can stay.
    documents = (
        keyed.select("id", content_hash(F.col("norm")).alias("hash"), F.sha2("norm", 256).alias("sha"))
        .groupBy("id", "hash", "sha").agg(F.count(F.lit(1)).alias("rows"))
    )
    joined = documents.join(text_classes(docs, id_column, text_column), ["hash", "sha"])
    return joined.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("sha").alias("text_sha256"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("row"),
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row") == 1)).alias("kept"), "text_sha256",
    )


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of rows that share the id and the normalised text, the one whose other values hash least."""
    columns = docs.columns
    norm = normalised(text_column)
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    # Rows are told apart by both digests, and among equal ones by all their values.
    whole = docs.select(F.col(id_column).alias("id"), norm.alias("norm"), row.alias("row"), F.xxhash64(row).alias("place"))
    whole = whole.select("id", content_hash(F.col("norm")).alias("hash"), F.sha2("norm", 256).alias("sha"), "row", "place")
    # Repeated rows collapse before the shuffle, and the join below reuses its partitioning.
    single = whole.groupBy("id", "hash", "sha").agg(F.min_by("row", "place").alias("row"))
    keepers = text_classes(docs, id_column, text_column).select(
        F.col("keep_id"), F.col("hash").alias("keep_hash"), F.col("sha").alias("keep_sha"))
    kept = single.join(keepers, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("hash") == F.col("keep_hash")) & (F.col("sha") == F.col("keep_sha")), "left_semi")
    return kept.select("row.*")
