"""Streams fed by several files give the batch answer."""

import pytest
from pyspark.sql import functions as F

from dayprints.operators import denstream as batch
from dayprints.operators import filters
from dayprints.operators import microclusters as mc
from dayprints.session import scratch_path
from dayprints.sources import events
from dayprints.streaming import denstream, slots
from tests.test_denstream import assert_same, collected

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark):
    """The events in three files of ten days each."""
    path = scratch_path(spark, "events-in")
    rows = events.table(spark, SF, "events")
    for part in range(3):
        days = (F.dayofmonth("ts") > part * 10) & (F.dayofmonth("ts") <= part * 10 + 10)
        rows.where(days).coalesce(1).write.mode("append").parquet(path)
    return path, rows.schema


def _stream(spark, folder):
    path, schema = folder
    return events.with_datapoint_columns(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path))


def test_slots_in_micro_batches(spark, folder):
    rows = _stream(spark, folder).withColumn("event_time", F.col("ts").cast("timestamp"))
    out = scratch_path(spark, "slots")
    slots.run_available(slots.slot_stream(rows), out, scratch_path(spark, "slots-cp"))
    got = slots.emitted(spark, out, slots.CLOSED)
    points = events.datapoints(spark, SF)
    end = points.agg(F.max("ts")).first()[0]
    start = F.window("ts", "30 minutes")["start"]
    want = points.groupBy("service", "user", start.alias("s")).agg(
        F.sum("distance").alias("v")).where(
        F.col("s") + F.expr("interval 30 minutes") <= F.lit(end) - F.expr("interval 2 days"))
    pairs = lambda df, s, v: sorted(
        (r["user"], str(r[s]), round(r[v], 6)) for r in df.collect())
    assert pairs(got, "slot_start", "value") == pairs(want, "s", "v")
    assert got.count() > 100


@pytest.mark.parametrize("order", [(2, 0, 1), (1, 2, 0)], ids=str)
def test_late_rows_are_kept_aside(spark, order):
    """Closed sums, late rows and the open rest are all rows, whatever came first."""
    path, out = scratch_path(spark, "late-in"), scratch_path(spark, "late-out")
    rows = events.datapoints(spark, SF).where("user in ('3', '7', '10')").select(
        "service", "user", "distance", F.col("ts").cast("timestamp").alias("event_time"))
    for part in order:
        days = F.floor(F.dayofmonth("event_time") / 11) == part
        rows.where(days).coalesce(1).write.mode("append").parquet(path)
        checkpoint = f"{out}-checkpoint"
        stream = spark.readStream.schema(rows.schema).parquet(path)
        slots.run_available(slots.slot_stream(stream), out, checkpoint)
    closed = slots.emitted(spark, out, slots.CLOSED).collect()
    late = slots.emitted(spark, out, slots.LATE).collect()
    end = rows.agg(F.max("event_time")).first()[0]
    import datetime as dt
    lag, slot = dt.timedelta(days=2), dt.timedelta(minutes=30)
    assert late and len({(r["user"], r["slot_start"]) for r in closed}) == len(closed)
    assert all(r["slot_start"] + slot <= end - lag for r in closed)
    still_open = [r for r in rows.collect() if r["event_time"] >= end - lag]
    assert sum(r["samples"] for r in closed) + len(late) <= rows.count()
    assert sum(r["samples"] for r in closed) + len(late) + len(still_open) >= rows.count()
    every = sorted((r["user"], r["event_time"], r["distance"]) for r in rows.collect())
    times = [(r["user"], r["event_time"], r["value"]) for r in late]
    assert all(t in every for t in times) and len(times) == len(set(times))
    total = sum(r["value"] for r in closed) + sum(r["value"] for r in late)
    done = {(r["user"], r["slot_start"]) for r in closed}
    rest = [r for r in rows.collect() if (r["user"], r["event_time"].replace(
        minute=r["event_time"].minute // 30 * 30, second=0, microsecond=0)) not in done
        and (r["user"], r["event_time"], r["distance"]) not in times]
    whole = sum(r["distance"] for r in rows.collect())
    assert total + sum(r["distance"] for r in rest) == pytest.approx(whole)
    assert all(r["event_time"] >= end - lag - slot for r in rest)


@pytest.mark.parametrize("p", [mc.Params(tp=20), mc.Params(clock="seconds", tp=400_000)], ids=str)
def test_clusters_in_micro_batches(spark, folder, p):
    out = scratch_path(spark, "clusters")
    rows = filters.geo(_stream(spark, folder))
    denstream.run_available(denstream.denstream_stream(rows, p), out,
                            scratch_path(spark, "clusters-cp"))
    emitted = spark.read.schema(denstream.OUT_DDL + ", batch bigint").parquet(out)
    assert emitted.select("batch").distinct().count() == 3
    got = denstream.current_clusters(emitted)
    want = batch.denstream(filters.geo(events.datapoints(spark, SF)), None, p)
    assert_same(collected(got), collected(want))


def test_stream_reads_a_folder_table_like_a_file(spark, tmp_path):
    from dayprints.catalog import streams
    source = "/root/testdata/sf0.001"
    spark.read.parquet(f"{source}/events.parquet").repartition(3).write.parquet(
        str(tmp_path / "events.parquet"))
    seen = []
    for folder in (source, str(tmp_path)):
        name = "rows_of_" + str(len(seen))
        query = (streams._stream(spark, folder).select("event_id").writeStream.format("memory")
                 .queryName(name).trigger(availableNow=True).start())
        query.awaitTermination()
        seen.append(sorted(r[0] for r in spark.table(name).collect()))
    assert seen[0] and seen[0] == seen[1]
