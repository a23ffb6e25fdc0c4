"""Evaluation of flagged samples against truth intervals.

Samples: node, ts, event_id, result. Truth events: name, start_ms, end_ms, node,
type ("single" or "multiple"), online. Clear intervals: name, start_ms, end_ms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayprints.functions.sensors import hop_distance
from dayprints.functions.student import half_width
from dayprints.functions.time import epoch_millis
from dayprints.operators.ordered import running
from dayprints.session import cut_lineage, measured

GRANULE_MS = 1 << 20  # about 17 minutes
LEVELS = 40


def _dyadic(start: str, end: str) -> Column:
    """(level, place) of the segments that make up the granules start .. end - 1.

    A segment of level l holds 2 ** l granules and begins at a multiple of them. Each level has
    two at most, so an interval of any length has some tens.
    """
    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        low = F.ceil(F.col(start) / size)
        high = F.floor(F.col(end) / size)
        odd_low, odd_high = (F.pmod(x, F.lit(2)) == 1 for x in (low, high))
        first = F.when(odd_low & (low < high), low)
        last = F.when(odd_high & (low + odd_low.cast("int") < high), high - 1)
        return F.transform(F.array_compact(F.array(first, last)), lambda place: F.struct(
            level.alias("level"), place.cast("bigint").alias("place")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), at))


def interval_join(samples: DataFrame, intervals: DataFrame, open_start: bool = False,
                  granule_ms: int = GRANULE_MS) -> DataFrame:
    """Samples inside intervals, both with times in ms.

    Intervals are cut into dyadic segments of whole granules around them, some tens for any
    length; a sample looks up the one segment that holds it on each level in use, then its time
    is tested. The segments are written, so the optimiser knows whether they can be broadcast;
    else AQE splits the samples of a busy segment. Events include their start, clears do not;
    both include their end. Intervals that end before they start hold nothing.
    """
    granule = lambda c: F.floor(F.col(c) / granule_ms)
    spread = intervals.where("start_ms <= end_ms").withColumns(
        {"__from": granule("start_ms"), "__to": granule("end_ms") + 1})
    segments = measured(spread.select(*intervals.columns, F.inline(_dyadic("__from", "__to")))
                        .withColumnsRenamed({"level": "__level", "place": "__place"}))
    levels = segments.agg(F.array_sort(F.collect_set("__level"))).scalar()
    size = F.call_function("shiftleft", F.lit(granule_ms).cast("bigint"), F.col("__level"))
    rows = samples.withColumn("__level", F.explode(levels)).withColumn(
        "__place", F.floor(F.col("ms") / size))
    joined = rows.join(segments, on=["__level", "__place"])
    start = F.col("ms") > F.col("start_ms") if open_start else F.col("ms") >= F.col("start_ms")
    return joined.where(start & (F.col("ms") <= F.col("end_ms"))).drop("__level", "__place")


def flagged(samples: DataFrame) -> DataFrame:
    """Flagged samples with their row number and the number of unflagged rows before.

    Neighbouring flagged rows share that number, which makes it a run id.
    """
    rows = running(samples.select("node", "ts", "event_id", "result"), ["node"],
                   ["ts", "event_id"], {
                       "rn": ("sum", F.lit(1).cast("bigint")),
                       "run": ("sum", F.when(F.col("result"), 0).otherwise(1).cast("bigint"))})
    return rows.where("result").select("node", epoch_millis("ts").alias("ms"), "rn", "run")


def flag_runs(inside: DataFrame) -> DataFrame:
    """Runs of consecutive flagged rows within each interval."""
    return inside.groupBy("node", "name", "run").agg(
        F.min("rn").alias("first_rn"), F.min("ms").alias("first_ms"),
        F.count(F.lit(1)).alias("length"))


def _singles(events: DataFrame, online: bool) -> DataFrame:
    kept = events.where("type = 'single'")
    return kept.where("online") if online else kept


def detections(samples: DataFrame, events: DataFrame, k_max: int = 5, online: bool = False,
               rows: DataFrame | None = None) -> DataFrame:
    """Detected single events: (node, name, k, delay_ms, hop).

    ``rows`` may hold the flagged rows of the samples, where several measures
    share them.

    For k, an event is detected by the k-th row of its first run of at least k
    flagged rows, which is the earliest row at position k of any run.
    """
    kept = _singles(events, online).select("name", "start_ms", "end_ms",
                                           F.col("node").alias("event_node"))
    inside = cut_lineage(interval_join(flagged(samples) if rows is None else rows, kept))
    runs = flag_runs(inside).select("node", "name", "run", "first_rn")
    at = (F.col("rn") - F.col("first_rn") + 1).cast("int")
    early = inside.join(runs, on=["node", "name", "run"]).withColumn("k", at).where(
        F.col("k") <= k_max)
    return early.groupBy("node", "name", "k", "event_node").agg(
        F.min(F.col("ms") - F.col("start_ms")).alias("delay_ms")).select(
        "node", "name", "k", "delay_ms", hop_distance("node", "event_node").alias("hop"))


def _per_node_and_k(samples: DataFrame, k_max: int) -> DataFrame:
    return samples.select("node").distinct().select(
        "node", F.explode(F.sequence(F.lit(1), F.lit(k_max))).alias("k"))


def detection(samples: DataFrame, events: DataFrame, k_max: int = 5, online: bool = False,
              rows: DataFrame | None = None) -> DataFrame:
    """Detected and all single events for every node and k."""
    found = detections(samples, events, k_max, online, rows).groupBy("node", "k").agg(
        F.count(F.lit(1)).alias("detections"))
    total = _singles(events, online).agg(F.count(F.lit(1)))
    return (_per_node_and_k(samples, k_max).join(found, on=["node", "k"], how="left")
            .fillna(0, ["detections"]).withColumn("events", total.scalar()))


def false_positives(samples: DataFrame, clears: DataFrame, k_max: int = 5,
                    rows: DataFrame | None = None) -> DataFrame:
    """Runs of at least k flagged rows inside clear intervals, for every node and k."""
    rows = flagged(samples) if rows is None else rows
    runs = flag_runs(interval_join(rows, clears, open_start=True))
    reached = F.sequence(F.lit(1), F.least(F.col("length"), F.lit(k_max)).cast("int"))
    count = runs.select("node", F.explode(reached).alias("k")).groupBy("node", "k").agg(
        F.count(F.lit(1)).alias("false_positives"))
    return (_per_node_and_k(samples, k_max).join(count, on=["node", "k"], how="left")
            .fillna(0, ["false_positives"]))


def _mean_and_width(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Mean and t half width of each measure; nulls do not count."""
    stats = df.groupBy(*keys).agg(*[
        f(m).alias(f"{m}_{name}") for m in measures
        for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("n", F.count))])
    widths = {f"{m}_width": half_width(F.col(f"{m}_std"), F.col(f"{m}_n")) for m in measures}
    return stats.withColumns(widths).drop(
        *[f"{m}_{name}" for m in measures for name in ("std", "n")])


def precision_recall(detected: DataFrame, false: DataFrame, clears: DataFrame) -> DataFrame:
    """Per k: mean over nodes and half width of recall, precision and false rate."""
    clear_count = clears.agg(F.count(F.lit(1))).scalar()
    rates = detected.join(false, on=["node", "k"]).select(
        "k",
        F.when(F.col("events") != 0, F.col("detections") / F.col("events")).alias("recall"),
        F.when(F.col("detections") != 0, F.col("detections")
               / (F.col("detections") + F.col("false_positives"))).alias("precision"),
        (F.col("false_positives") / (clear_count + 1)).alias("false_rate"))
    out = _mean_and_width(rates, ["k"], ["recall", "precision", "false_rate"])
    capped = F.when(F.col("k") == 1, F.least("false_rate_mean", F.lit(1.0)))
    return out.withColumns({
        "recall_mean": F.coalesce("recall_mean", F.lit(0.0)),
        "precision_mean": F.coalesce("precision_mean", F.lit(0.0)),
        "false_rate_mean": capped.otherwise(F.col("false_rate_mean"))})


def delay_by_hop(found: DataFrame, sampling_rate: float = 5.0) -> DataFrame:
    """Mean detection delay and half width for each k and hop distance."""
    delay = F.col("delay_ms") / (1000.0 * sampling_rate)
    return _mean_and_width(found.withColumn("delay", delay), ["k", "hop"], ["delay"])
