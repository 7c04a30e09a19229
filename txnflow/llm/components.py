"""Connected components of a link table, by alternating star contraction.

Each round is a grouped minimum and a join, and its result is written to the shared folder, so nothing is
collected and lineage stays short. A node with very many links is a hot key of a sorted join, which
adaptive execution splits; minima are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.session import stage


def _point_to_least(links: DataFrame, with_self: bool) -> DataFrame:
    """Every neighbour of ``u`` points to the least of them and ``u``; ``links`` are directed, u to v."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    out = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if with_self:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``u``, ``v``): the root is the least node that can be reached."""
    links = stage(links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: greater neighbours point to the least node around; small star: the others do.
        large = stage(_point_to_least(both, False).where(F.col("u") > F.col("v")), "large")
        links = stage(_point_to_least(large, True), "small")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
