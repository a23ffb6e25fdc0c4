"""Streaming forms T1 and T2, run over the files present until they are used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints.catalog import places
from dayprints.catalog.common import SQL, rnd
from dayprints.operators import filters
from dayprints.session import scratch_path
from dayprints.sources import events
from dayprints.streaming import denstream as den
from dayprints.streaming import slots


def _stream(spark, sf):
    """The events table, one file or a folder of files, as a file stream of datapoints."""
    schema = events.table(spark, sf, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    return events.with_datapoint_columns(rows)


def slots_stream(spark, sf):
    """Half-hour sums that the two-day watermark has closed."""
    rows = _stream(spark, sf).select("service", "user", "distance",
                                     F.col("ts").cast("timestamp").alias("event_time"))
    path = scratch_path(spark, "slots-out")
    slots.run_available(slots.slot_stream(rows), path, scratch_path(spark, "slots-state"))
    out = slots.emitted(spark, path, slots.CLOSED)
    return out.withColumns({"slot_start": F.col("slot_start").cast("timestamp_ntz"),
                            "value": rnd("value")})


def denstream_stream(spark, sf):
    """Clusters of each user after the stream."""
    rows = filters.no_sentinel(filters.geo(_stream(spark, sf)))
    path = scratch_path(spark, "clusters-out")
    den.run_available(den.denstream_stream(rows), path, scratch_path(spark, "clusters-state"))
    found = den.current_clusters(spark.read.schema(den.OUT_DDL + ", batch bigint").parquet(path))
    return found.drop("batch").withColumns({c: places.plain(c) for c in places.SUMS[:5]})


QUERIES = {
    "slots_stream": slots_stream,
    "denstream_stream": denstream_stream,
}

ORACLES = {
    "slots_stream": SQL + """, w as (
          select service, "user", time_bucket(interval '30 minutes', ts) as slot_start, distance
          from dp)
        select service, "user", slot_start, round(sum(distance), 6) as value, count(*) as samples
        from w where slot_start + interval '30 minutes' <=
          (select date_trunc('millisecond', max(ts)) - interval '2 days' from dp)
        group by all""",
    "denstream_stream": places._STATES + places._STATE_SQL + ", k as last_step from cl",
}
