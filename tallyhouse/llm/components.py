"""Connected components of an edge table, by alternating star steps over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import shared_folder, stored


def components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """``node, root``: the smallest node of each node's component, for every node of ``edges`` (``u``, ``v``).

    Large-star and small-star steps move every node's links to the smallest neighbour until nothing changes; the number
    of rounds grows with the logarithm of the longest chain. Minima are aggregated before the shuffle, the join of the
    minima with the links is one that Spark splits where a node has very many links. Each round is a written table.
    """
    folder = folder or shared_folder(edges.sparkSession)
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                 folder, "edges")
    turn, mark = 0, _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour of a node moves to the node's smallest neighbour (or the node itself).
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: a node and its smaller neighbours move to the smallest of them.
        large = large.where("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small_low.select("u", F.col("m").alias("v"))).distinct()
        now = stored(small, folder, f"edges_{turn}")
        before, mark, turn = mark, _mark(now), turn + 1
        if before == mark:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
