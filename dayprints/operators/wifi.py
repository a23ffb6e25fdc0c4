"""Wifi scans: vocabulary, multi-hot vectors, and the scan next to a position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayprints.functions.sensors import top_wifis
from dayprints.functions.time import epoch_millis
from dayprints.operators.ordered import ranged, row_numbers
from dayprints.session import cut_lineage, measured


def scan_hashes(scans: DataFrame, keys: list[str], n: int = 5,
                order: str = "strongest") -> DataFrame:
    """One row per kept access point of a scan: (keys, event_id, ts, pos, hash)."""
    return scans.select(*keys, "event_id", "ts",
                        F.posexplode(top_wifis("wifis", n, order)).alias("pos", "hash"))


def vocabulary(hashes: DataFrame, keys: list[str]) -> DataFrame:
    """Index of each hash in first-seen order, from 0, per key."""
    seen = hashes.groupBy(*keys, "hash").agg(
        F.min(F.struct("ts", "event_id", "pos")).alias("seen"))
    ranked = row_numbers(seen.select(*keys, "hash", "seen.*"), keys, ["ts", "event_id", "pos"],
                         "idx")
    return ranked.select(*keys, "hash", (F.col("idx") - 1).cast("int").alias("idx"))


def multihot(scans: DataFrame, keys: list[str], order: str = "strongest") -> DataFrame:
    """Sparse vectors: one (scan, index) row for each 1."""
    hashes = cut_lineage(scan_hashes(scans, keys, order=order))
    return _indexed(hashes, measured(vocabulary(hashes, keys)), keys)


def _indexed(hashes: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    return hashes.join(words, on=[*keys, "hash"]).select(*keys, "event_id", "idx")


def dense_vectors(scans: DataFrame, keys: list[str], order: str = "strongest") -> DataFrame:
    """0/1 arrays as long as the key's vocabulary (scans without wifi give zeros)."""
    hashes = cut_lineage(scan_hashes(scans, keys, order=order))
    words = measured(vocabulary(hashes, keys))
    size = words.groupBy(*keys).agg((F.max("idx") + 1).alias("size"))
    sparse = _indexed(hashes, words, keys).groupBy(*keys, "event_id").agg(F.collect_set("idx").alias("ones"))
    rows = scans.select(*keys, "event_id").join(size, on=keys).join(
        sparse, on=[*keys, "event_id"], how="left")
    bit = lambda i: F.array_contains("ones", i.cast("int")).cast("int")
    return rows.select(*keys, "event_id", F.transform(
        F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.coalesce(bit(i), F.lit(0))
    ).alias("vector"))


def nearest_scan(points: DataFrame, scans: DataFrame, keys: list[str], payload: Column,
                 seconds: int = 60) -> DataFrame:
    """Add ``scan``: payload and time of the nearest scan within ``seconds``, or null.

    Ties go to the earlier scan. Points and scans are merged in time order over ranges of about
    equal size, so a busy minute of a key is several tasks. The last scan of the ranges before,
    and the first of those behind, stand as carried rows at the two ends of each range; no pairs
    are formed and nothing is joined.
    """
    order = ["__t", "__kind", "__id"]
    left = points.withColumns({"__t": epoch_millis("ts"), "__kind": F.lit(1),
                               "__id": F.col("event_id")})
    right = scans.select(*keys, epoch_millis("ts").alias("__t"), F.lit(0).alias("__kind"),
                         F.col("event_id").alias("__id"), payload.alias("payload"))
    right = right.withColumn("__scan", F.struct(F.col("__t").alias("t"), "payload"))
    both = ranged(left.unionByName(right.drop("payload"), allowMissingColumns=True), keys, order)

    at = F.when(F.col("__kind") == 0, F.struct("__t", "__id"))
    ends = both.groupBy(*keys, "__range").agg(F.max_by("__scan", at).alias("__last"),
                                              F.min_by("__scan", at).alias("__first"))
    behind = (Window.unboundedPreceding, -1)
    of_key = Window.partitionBy(*keys)
    ends = ends.select(
        *keys, "__range",
        F.last("__last", ignorenulls=True).over(
            of_key.orderBy("__range").rowsBetween(*behind)).alias("__last"),
        F.last("__first", ignorenulls=True).over(
            of_key.orderBy(F.desc("__range")).rowsBetween(*behind)).alias("__first"))
    carried = ends.select(*keys, "__range", F.inline(F.array(
        F.struct(F.lit(-1).alias("__end"), F.col("__last").alias("__scan")),
        F.struct(F.lit(1).alias("__end"), F.col("__first").alias("__scan")))))
    every = both.withColumn("__end", F.lit(0)).unionByName(carried, allowMissingColumns=True)

    # a frame up to the last row is summed up anew for each row, so the scan behind a point is
    # sought backwards
    window = Window.partitionBy(*keys, "__range")
    so_far = (Window.unboundedPreceding, 0)
    before = F.last("__scan", ignorenulls=True).over(
        window.orderBy("__end", *order).rowsBetween(*so_far))
    after = F.last("__scan", ignorenulls=True).over(
        window.orderBy(*[F.desc(c) for c in ["__end", *order]]).rowsBetween(*so_far))
    out = every.withColumns({"__before": before, "__after": after}).where("__kind = 1")
    reach = seconds * 1000
    back = F.col("__t") - F.col("__before.t")
    ahead = F.col("__after.t") - F.col("__t")
    best = (F.when((back <= reach) & (back <= F.coalesce(ahead, back)), F.col("__before"))
            .when(ahead <= reach, F.col("__after")))
    return out.withColumn("scan", best).select(*points.columns, "scan")
