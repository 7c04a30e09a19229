"""The corpus pipeline: five stages that each call one operator over all that the stage before kept.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``; the last returns the packed
pieces. ``run`` writes each result as Parquet in the folder of ``spark.checkpoint.dir`` and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.llm.common import table, text_or_empty
from txnflow.llm.exact_dedup import keep_first
from txnflow.llm.language import document_evidence, fit_text_model, identify
from txnflow.llm.packing import pack_documents
from txnflow.llm.passages import remove_repeats
from txnflow.llm.queries import WORD_BPE
from txnflow.llm.simhash import keep_one
from txnflow.session import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by their evidence stay.

    Rejected documents are named by all that the decision looks at, so rows with equal or missing ids are told apart.
    """
    looked_at = F.xxhash64(text_or_empty("text"), F.col("lang"), F.col("source"))
    keyed = docs.select(F.col("doc_id").alias("key_id"), looked_at.alias("key_hash"),
                        *[column.alias(name) for name, column in document_evidence().items()])
    found = identify(keyed, ("key_id", "key_hash"), fit_text_model(docs))
    rejected = stage(found.where("NOT accepted").select("key_id", "key_hash").distinct(), "rejected")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), looked_at.alias("hash"))
    same = F.col("id").eqNullSafe(F.col("key_id")) & (F.col("hash") == F.col("key_hash"))
    return rows.join(rejected, same, "left_anti").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    return keep_first(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints of word triples are linked at three bits, directly or by way of others, the one with the smallest id stays."""
    return keep_one(docs, words=3, bits=3)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut from the texts; ``n_chars`` follows. Documents stay, empty ones too."""
    spans = "removed_spans"
    while spans in {c.lower() for c in docs.columns}:
        spans += "_"
    cut = remove_repeats(docs, removed_column=spans)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, each with its sequence and place there."""
    return pack_documents(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("passage_dedup", passage_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Trigram models, fingerprints and byte pairs are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
