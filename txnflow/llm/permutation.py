"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its ``prefix`` nearest pivots. In each block of rows these orders are posted in inverted
files, one a pivot, holding the rows and the position the pivot has for them. A query reads the files of its own ``reads`` nearest pivots, an eighth of all by default, and
adds up, for every row, how far positions differ (Spearman's footrule over these pivots; a pivot that a row does not rank counts as
if it came last). The closest part of the block by footrule is reranked by the cosine of the original vectors.

* Equal vectors are one class, whose smallest ids are all that an answer can name: a vector that a third of the rows share is
  indexed and ranked once, and each map task sends no more than a few of its rows.
* Blocks hold about ``block_rows`` classes by a hash; queries go to blocks in groups of ``query_rows``. A task sees one
  block and one group of queries, so its memory is bounded, and the best of a block are merged with a limit a query.
* Pivots are ``pivots`` classes, those with the smallest hash of their id: a bounded sample. Every row is indexed.

Recall against brute force depends on ``pivots``, ``reads`` and ``share``, the part of each block that is reranked, alike at every size. See the README for measured recall.

Defined results: ids or vectors that are null, vectors that are zero, hold null or non-finite components or are not of
the most frequent length take no part; equal scores go to the smaller id; rows that repeat id and vector count once;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.llm.common import ship_package
from txnflow.session import stage


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id``, ``vec`` (doubles) of the rows that can take part."""
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    length = rows.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (length[0]["n"] if length else 0))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Cosines:
    """Cosines in double precision; the sums run alike for every row, so equal vectors have equal scores."""

    def __init__(self, rows: np.ndarray):
        self.scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
        self.length = np.sqrt((self.scaled * self.scaled).sum(axis=1))

    def to(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        query = query / np.abs(query).max()
        return (self.scaled[rows] * query).sum(axis=1) / (self.length[rows] * np.sqrt((query * query).sum()))


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the ``prefix`` nearest pivots of each vector, nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix]


class InvertedFiles:
    """Rows that rank a pivot, and the position they give it, for every pivot."""

    def __init__(self, ranked: np.ndarray, pivots: int):
        self.rows, self.prefix = ranked.shape
        row, position = np.divmod(np.arange(ranked.size), self.prefix)
        by_pivot = np.argsort(ranked.ravel(), kind="stable")
        self.row, self.position = row[by_pivot], position[by_pivot].astype(np.int16)
        self.ends = np.searchsorted(ranked.ravel()[by_pivot], np.arange(pivots + 1))

    def footrule(self, asked: np.ndarray) -> np.ndarray:
        """Distance of every row to the order of each query, a row a query."""
        pivots = len(self.ends) - 1
        place = np.full((len(asked), pivots), -1, np.int16)
        np.put_along_axis(place, asked, np.arange(asked.shape[1], dtype=np.int16)[None, :], axis=1)
        # As if no query pivot were ranked; each file then says what its rows are nearer by.
        most = int(sum(self.prefix - i for i in range(asked.shape[1])))
        total = np.full((len(asked), self.rows), most, np.int16 if most < 1 << 14 else np.int32)
        for pivot in range(pivots):
            start, stop = self.ends[pivot], self.ends[pivot + 1]
            who = np.flatnonzero(place[:, pivot] >= 0)
            own = place[who, pivot][:, None]
            change = np.abs(self.position[start:stop] - own) - (np.int16(self.prefix) - own)
            if stop - start == self.rows:  # the file holds every row, in order
                total[who] += change
            elif len(who) and stop > start:
                total[who[:, None], self.row[start:stop]] += change
        return total


#: Queries whose distances to a block are held at once.
TOGETHER = 256


def search_block(block: pd.DataFrame, queries: pd.DataFrame, pivots: np.ndarray, prefix: int, reads: int, share: float, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the block, scores) of the ``k`` best rows found for each query."""
    rows, asked = np.stack(block["vec"].to_numpy()), np.stack(queries["query_vec"].to_numpy())
    files, cosines = InvertedFiles(orders(unit(rows), pivots, prefix), len(pivots)), Cosines(rows)
    keep = min(len(rows), max(k, int(np.ceil(share * len(rows)))))
    ids = block["class_id"].to_numpy()
    ranked = orders(unit(asked), pivots, reads)
    for begin in range(0, len(asked), TOGETHER):
        part = slice(begin, begin + TOGETHER)
        for query, distance in zip(asked[part], files.footrule(ranked[part]), strict=True):
            # Rows at the last distance that still counts are all taken.
            near = np.flatnonzero(distance <= np.partition(distance, keep - 1)[keep - 1])
            score = cosines.to(query, near)
            if len(score) > k:
                top = score >= np.partition(score, -k)[-k]
                near, score = near[top], score[top]
            best = np.lexsort((ids[near], -score))[:k]
            yield near[best], score[best]


def permutation_neighbours(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id",
                           vector_column: str = "embedding", pivots: int = 256, prefix: int = 256, reads: int = 32, share: float = 0.15,
                           block_rows: int = 2048, query_rows: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other rows found for the rows where ``is_query`` holds.

    ``is_query`` is an expression over ``id``; ``reads`` is ``prefix`` at most.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = usable(vectors, id_column, vector_column)

    # Classes of equal vectors with their k + 1 smallest ids: one may be the query itself.
    smallest = Window.partitionBy("vec").orderBy("id")
    classes = stage(
        rows.groupBy("vec", "id").agg(F.lit(1).alias("one"))
        .withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
        .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.element_at("ids", 1).alias("class_id"), "vec", "ids"), "classes")
    queries = stage(rows.where(is_query).select("id", "vec").distinct().join(classes.select("vec", "class_id"), "vec")
                    .select("id", "class_id"), "queries")
    asked = classes.join(queries.select("class_id").distinct(), "class_id", "left_semi")

    sample = classes.orderBy(F.xxhash64("class_id"), "class_id").limit(pivots).select("vec").collect()
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    nearest_to = spark.sparkContext.broadcast(unit(np.array([row["vec"] for row in sample])))
    prefix = min(prefix, len(sample))
    reads = min(reads, prefix)

    blocks = max(1, -(-classes.count() // block_rows))
    groups = max(1, -(-asked.count() // query_rows))
    block_of = F.pmod(F.xxhash64("class_id"), F.lit(blocks)).alias("block")
    group_of = F.pmod(F.xxhash64("class_id"), F.lit(groups)).alias("part")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    data = classes.select("class_id", "vec", "ids", block_of, every(groups).alias("part"))
    wanted = asked.select(F.col("class_id").alias("query_class"), F.col("vec").alias("query_vec"), every(blocks).alias("block"), group_of)

    def run(block: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(part):
            return pd.DataFrame({"query_class": [], "class_id": [], "ids": [], "score": []})
        found = list(search_block(block, part, nearest_to.value, prefix, reads, share, k + 1))
        at = np.concatenate([rows for rows, _ in found])
        return pd.DataFrame({
            "query_class": np.repeat(part["query_class"].to_numpy(), [len(rows) for rows, _ in found]), "class_id": block["class_id"].to_numpy()[at],
            "ids": block["ids"].to_numpy()[at], "score": np.concatenate([score for _, score in found])})

    found = data.groupBy("block", "part").cogroup(wanted.groupBy("block", "part")).applyInPandas(
        run, "query_class bigint, class_id bigint, ids array<bigint>, score double")
    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
    answers = (
        found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
        .groupBy("query_class").agg(F.collect_list(F.struct((-F.col("score")).alias("far"), "ids")).alias("near"))
    )
    named = F.flatten(F.transform("near", lambda c: F.transform(c["ids"], lambda i: F.struct(c["far"].alias("far"), i.alias("id")))))
    others = F.slice(F.array_sort(F.filter(named, lambda x: x["id"] != F.col("query_id"))), 1, k)
    return (
        queries.withColumnRenamed("id", "query_id").join(answers, F.col("class_id") == F.col("query_class"))
        .select("query_id", F.posexplode(others).alias("at", "found"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("found.id").alias("vec_id"), (-F.col("found.far")).alias("score"))
    )
