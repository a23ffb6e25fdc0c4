"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum (with map-side partials) and a join, so a node
with very many neighbours is never gathered in one place. Components shrink to
stars in a number of rounds logarithmic in practice, also for long chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayprints.session import cut_lineage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(lowest, on="u").where("v > u").select(F.col("v").alias("u"),
                                                           F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, on="u").where("v <> m").select(F.col("v").alias("u"),
                                                              F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; component is its smallest node.

    ``edges`` has two columns of one comparable type, in any direction.
    """
    a, b = edges.columns
    current = cut_lineage(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    signature = _signature(current)
    while signature[0]:
        following = cut_lineage(_small_star(_large_star(current)))
        reached = _signature(following)
        current = following
        if reached == signature:
            break
        signature = reached
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
