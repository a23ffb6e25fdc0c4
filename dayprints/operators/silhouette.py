"""Silhouette of a labelling: exact for Euclidean distance, or linear for squared distance.

``silhouette_squared`` needs each cluster's size, mean and spread only: the mean squared distance
of a point to a cluster's members is its squared distance to their mean plus their variance.

``silhouette`` is the Euclidean one. Equal positions of a cluster are one weighted position. Every position needs its
distance sum to every cluster, so the arithmetic is quadratic in a key's
positions by definition. They are dealt into blocks of bounded size; a pair of
blocks is one row, spread over all tasks, and only sums per (position, cluster)
leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayprints.operators.keyed import join_same
from dayprints.session import cut_lineage, measured

BLOCK = 1024


def _block_sums(batches: Iterator[pd.DataFrame], by: str) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            labels, code = np.unique(np.asarray(row.rl), return_inverse=True)
            dx = np.subtract.outer(np.asarray(row.lx), np.asarray(row.rx))
            dy = np.subtract.outer(np.asarray(row.ly), np.asarray(row.ry))
            weight = np.asarray(row.rw)
            member = np.eye(len(labels))[code] * weight[:, None]
            sums = np.sqrt(dx * dx + dy * dy) @ member
            n = len(row.lid)
            yield pd.DataFrame({
                by: [getattr(row, by)] * sums.size,
                "id": np.repeat(np.asarray(row.lid), len(labels)),
                "own": np.repeat(np.asarray(row.ll), len(labels)),
                "weight": np.repeat(np.asarray(row.lw), len(labels)),
                "label": np.tile(labels, n),
                "total": sums.ravel(),
                "members": np.tile(member.sum(axis=0).round().astype("int64"), n)})


def position_silhouettes(df: DataFrame, by: str, id_: str = "event_id", label: str = "label",
                         x: str = "longitude", y: str = "latitude", block: int = BLOCK
                         ) -> DataFrame:
    """(by, id, weight, silhouette) per position, known by the smallest id there.

    A cluster of one has silhouette 0, as is usual. Noise (-1) counts as a
    cluster. Positions of keys with a single label are left out.
    """
    spots = df.groupBy(by, F.col(label).alias("l"), F.col(x).alias("x"), F.col(y).alias("y")).agg(
        F.min(id_).alias("id"), F.count(F.lit(1)).alias("w"))
    spots = cut_lineage(spots)
    size = spots.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    rows = spots.join(measured(size), on=by)
    rows = rows.withColumn("b", F.pmod(F.xxhash64("id"), F.col("blocks")))
    fields = ["id", "l", "x", "y", "w"]
    blocks = rows.groupBy(by, "b", "blocks").agg(F.collect_list(F.struct(*fields)).alias("p"))
    left = blocks.select(by, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"),
                         *[F.col(f"p.{c}").alias(f"l{c}") for c in fields])
    right = blocks.select(by, "b", *[F.col(f"p.{c}").alias(f"r{c}") for c in fields[1:]])
    # enough partitions for numpy work on small input, too
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = left.join(right, on=[by, "b"]).repartition(n).drop("b")
    key = df.schema[by].dataType.simpleString()
    sums = pairs.mapInPandas(
        lambda batches: _block_sums(batches, by),
        f"`{by}` {key}, id bigint, own bigint, weight bigint, label bigint, total double, "
        "members bigint")
    means = sums.groupBy(by, "id", "own", "weight", "label").agg(
        F.sum("total").alias("total"), F.sum("members").alias("members"))
    inside = F.col("label") == F.col("own")
    spot = means.groupBy(by, "id", "weight").agg(
        F.max(F.when(inside, F.col("members"))).alias("size"),
        F.max(F.when(inside, F.try_divide("total", F.col("members") - 1))).alias("a"),
        F.min(F.when(~inside, F.col("total") / F.col("members"))).alias("b"))
    s = F.when(F.col("size") == 1, 0.0).otherwise(
        F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)),
                   F.lit(0.0)))
    return spot.where("b is not null").select(by, "id", "weight", s.alias("silhouette"))


def silhouette(df: DataFrame, by: str, **columns) -> DataFrame:
    """Mean silhouette per key, over all points."""
    spots = position_silhouettes(df, by, **columns)
    return spots.groupBy(by).agg(
        (F.sum(F.col("silhouette") * F.col("weight")) / F.sum("weight")).alias("silhouette"))


def silhouette_squared(df: DataFrame, by: str, label: str = "label", x: str = "longitude",
                       y: str = "latitude") -> DataFrame:
    """Mean silhouette per key under squared Euclidean distance, in one pass over the points.

    With d(p, C) = |p - mean of C|^2 + variance of C, the mean squared distance to C's members:
    a = d(p, own) * n / (n - 1), without the point itself, b = the least d(p, other), and the
    silhouette (b - a) / max(a, b). A cluster of one has 0; noise (-1) counts as a cluster; keys
    with a single label are left out; points with a null are too. The time is the number of
    points times a key's clusters, which stand as one list per key.
    """
    points = df.select(by, F.col(label).alias("l"), F.col(x).alias("x"),
                       F.col(y).alias("y")).dropna(subset=["l", "x", "y"])
    shapes = points.groupBy(by, "l").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"),
        (F.var_pop("x") + F.var_pop("y")).alias("var"))
    lists = measured(shapes.groupBy(by).agg(F.collect_list(
        F.struct("l", "n", "mx", "my", "var")).alias("clusters")).where(F.size("clusters") > 1))
    rows = join_same(points, lists, [by])

    def away(c):
        dx, dy = F.col("x") - c["mx"], F.col("y") - c["my"]
        return dx * dx + dy * dy + c["var"]

    own = F.filter("clusters", lambda c: c["l"] == F.col("l"))[0]
    others = F.filter("clusters", lambda c: c["l"] != F.col("l"))
    a = away(own) * own["n"] / F.nullif(own["n"] - 1, F.lit(0))
    rows = rows.select(by, a.alias("a"), F.array_min(F.transform(others, away)).alias("b"))
    s = F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)),
                   F.lit(0.0))
    return rows.groupBy(by).agg(F.avg(F.when(F.col("a").isNull(), 0.0).otherwise(s))
                                .alias("silhouette"))
