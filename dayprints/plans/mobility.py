"""The mobility job: slot tables of new user-days, and the marks that follow."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dayprints import schemas
from dayprints.operators import filters, marks, slots
from dayprints.session import cut_lineage, own_steps
from dayprints.sources.tables import read_table_or_empty, replace_table, write_table

DATA_TYPE = "mobility"
PARENT = ["service", "user", "day"]


@dataclass(frozen=True)
class Outputs:
    header: DataFrame
    distance: DataFrame
    speed: DataFrame
    marks: DataFrame


def slot_tables(points: DataFrame, stored_marks: DataFrame, as_of: str) -> Outputs:
    """All tables of a run.

    The samples are read once: one aggregate per (user-day, source, slot) holds
    everything, and marks and lags are applied to its rows, since they depend on
    the day only. At-home has a longer lag and no mark: all its closed days are here.
    """
    closed = filters.settled(filters.mobility(points), as_of, lag=2)
    base = cut_lineage(slots.slot_base(closed))
    new = marks.incremental(base, stored_marks, DATA_TYPE, as_of)
    header = marks.day_header(new, DATA_TYPE)

    by_source = [*PARENT, "source"]
    pick = lambda df, c, *keys: df.select(*keys, "slot", F.col(c).alias("value"))
    folded = slots.fold_sources(new)
    home = slots.fold_sources(filters.settled(base, as_of, lag=4))
    home_vector = slots.slot_vector(pick(home, "home", *PARENT), PARENT, "home")
    distance = (
        slots.slot_vector(pick(new, "distance_sum", *by_source), by_source, "mean")
        .unionByName(slots.slot_vector(pick(new, "distance_var", *by_source), by_source, "var"))
        .unionByName(home_vector.withColumn("source", F.lit("app"))))
    speed = (slots.slot_vector(pick(folded, "speed_mean", *PARENT), PARENT, "mean")
             .unionByName(slots.slot_vector(pick(folded, "speed_var", *PARENT), PARENT, "var")))

    current = stored_marks.where(F.col("data_type") == DATA_TYPE)
    merged = marks.marks_merge(current, marks.latest_mark(header))
    others = stored_marks.where(F.col("data_type") != DATA_TYPE)
    return Outputs(header, distance, speed, marks.union_marks(merged, others))


def run(spark, points: DataFrame, store: dict, as_of: str) -> dict:
    """Run the job against stored tables; returns user-days, slot rows written and seconds.

    Marks are written last, and each table takes only rows whose key it does not hold
    yet, so a run that died anywhere is simply repeated.
    """
    with own_steps(spark):
        return _run(spark, points, store, as_of)


def _run(spark, points: DataFrame, store: dict, as_of: str) -> dict:
    began = time.monotonic()
    stored_marks = read_table_or_empty(spark, "last_modification", store, schemas.MARKS)
    out = slot_tables(points, stored_marks, as_of)

    days = Observation("user-days")
    header = cut_lineage(out.header.select("service", "user", "date").distinct()
                         .observe(days, F.count(F.lit(1)).alias("n")))
    stored = read_table_or_empty(spark, "mobility_summary", store, header.schema)
    write_table(marks.new_headers(header, stored), "mobility_summary", store)
    written = {}
    for name, rows, key in (("distance", out.distance, [*PARENT, "source", "type"]),
                            ("speed", out.speed, [*PARENT, "type"])):
        stored = read_table_or_empty(spark, name, store, rows.schema)
        seen = Observation(name)  # the count comes with the write
        fresh = cut_lineage(marks.unstored(rows, stored, key)
                            .observe(seen, F.count(F.lit(1)).alias("n")))
        written[name] = seen.get["n"]
        write_table(fresh, name, store, partition_by="day")
    replace_table(out.marks, "last_modification", store)
    return {"rows": written["distance"], "user_days": days.get["n"],
            "seconds": time.monotonic() - began}
