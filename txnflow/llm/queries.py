"""Registered queries of this subpackage: each operator over its whole table, with the digests its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.llm.bpe import encode_texts
from txnflow.llm.common import ASCII_SPACE, table
from txnflow.llm.exact_dedup import exact_groups
from txnflow.llm.html_text import extract_text
from txnflow.llm.language import document_evidence, fit_text_model, identify, page_evidence
from txnflow.llm.packing import pack_documents
from txnflow.llm.passages import remove_repeats
from txnflow.llm.permutation import permutation_neighbours
from txnflow.llm.quality import pu_scores
from txnflow.llm.runs import periodic_runs
from txnflow.llm.shards import shard_rows
from txnflow.llm.simhash import near_duplicates
from txnflow.llm.url_filter import url_filter
from txnflow.llm.whitening import whiten

#: Vocabulary of the public tokenizer that the queries use; operators take any path.
WORD_BPE = "word_bpe_49k.json"

#: Fixed values of the URL contract.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages alike: ``doc_id`` is null for pages, ``page_id`` for documents."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    none = F.lit(None).cast("bigint")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), none.alias("page_id"),
                       *[c.alias(name) for name, c in document_evidence().items()]).unionByName(
        pages.select(none.alias("doc_id"), F.col("page_id").cast("bigint").alias("page_id"),
                     *[c.alias(name) for name, c in page_evidence().items()]))
    found = identify(rows, ("doc_id", "page_id"), fit_text_model(docs))
    return found.withColumnRenamed("accepted", "kept")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_deletion_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, bits=3)


def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_rows(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "text", F.size("removed").alias("n_removed"), "removed")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pu_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op9_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in one document in ten, told by the checksum of its id, the words from a place on repeat a stretch of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, chosen = F.floor(h / 10), F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.select("doc_id", "text", g.alias("g"),
                       F.when(chosen, F.filter(F.split("text", ASCII_SPACE), lambda w: w != "")).alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n")), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_synchronised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=16)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_permutation_index, op2_language_id, op3_exact_dedup, op4_deletion_simhash, op5_feistel_shards, op6_passage_dedup,
        op7_bpe, op8_pu_quality, op9_best_two_fit, op10_url_filter, op11_synchronised_runs, op12_tag_path_text, op13_whitening,
    )
}
