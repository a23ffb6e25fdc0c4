"""The social job: calls and applications of new user-days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayprints import schemas
from dayprints.operators import filters, marks, social
from dayprints.session import cut_lineage
from dayprints.sources.tables import read_table_or_empty, replace_table, write_table

DATA_TYPE = "social"


def tables(points: DataFrame, stored_marks: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """Call register, application usage and the headers of their user-days."""
    calls = marks.incremental(filters.calls(points), stored_marks, DATA_TYPE, as_of)
    apps = marks.incremental(points.where("apps is not null"), stored_marks, DATA_TYPE, as_of)
    usage = social.app_usage(apps)
    days = social.calls_apps_outer(calls, usage)
    return {"call_register": social.call_register(calls), "appusage": usage,
            "social_summary": marks.day_header(days, DATA_TYPE)}


def run(spark, points: DataFrame, store: dict, as_of: str) -> None:
    """Run the job against stored tables.

    Marks are written last, and a table takes only user-days that it does not hold yet, so
    a run that died is repeated. An append counts as whole or absent, as its commit makes it.
    """
    stored_marks = read_table_or_empty(spark, "last_modification", store, schemas.MARKS)
    out = tables(points, stored_marks, as_of)
    header = cut_lineage(out["social_summary"])
    days = header.select("service", "user", "date")
    stored = read_table_or_empty(spark, "social_summary", store, days.schema)
    write_table(marks.new_headers(days, stored), "social_summary", store)
    first = days.agg(F.min("date")).first()[0]
    for name in ("call_register", "appusage"):
        # only days of this run can be held already; the filter prunes the others' folders
        stored = read_table_or_empty(spark, name, store, out[name].schema)
        held = stored.where(F.col("day") >= F.lit(first)).select(*social.DAY).distinct()
        write_table(marks.unstored(out[name], held, social.DAY), name, store, partition_by="day")
    current = stored_marks.where(F.col("data_type") == DATA_TYPE)
    merged = marks.marks_merge(current, marks.latest_mark(header))
    others = stored_marks.where(F.col("data_type") != DATA_TYPE)
    replace_table(marks.union_marks(merged, others), "last_modification", store)
