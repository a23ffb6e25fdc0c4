"""Headers and marks: A7, A8, J1-J4, U1, U2."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints.catalog.common import NEW_SQL, SQL, new_rows, points
from dayprints.operators import marks
from dayprints.sources import events

STORED_BEFORE = "2024-01-15"


def day_header(spark, sf):
    return marks.day_header(new_rows(spark, sf), "mobility")


def latest_mark(spark, sf):
    return marks.latest_mark(day_header(spark, sf))


def _mobility_marks(spark, sf):
    return events.marks(spark, sf).where("data_type = 'mobility'")


def marks_other(spark, sf):
    return marks.marks_other(events.marks(spark, sf), _mobility_marks(spark, sf))


def marks_merge(spark, sf):
    return marks.marks_merge(_mobility_marks(spark, sf), latest_mark(spark, sf))


def union_marks(spark, sf):
    return marks.union_marks(marks_merge(spark, sf), marks_other(spark, sf))


def new_headers(spark, sf):
    """Headers of the run that are not among the stored ones."""
    stored = marks.day_header(points(spark, sf), "mobility").where(f"date < '{STORED_BEFORE}'")
    return marks.new_headers(day_header(spark, sf), stored).select("service", "user", "date")


def mark_lookup(spark, sf):
    return marks.mark_lookup(points(spark, sf), events.marks(spark, sf), "mobility").select(
        "event_id", F.coalesce("mark", F.lit("1970-01-01").cast("date")).alias("mark"))


def distinct_rows(spark, sf):
    return points(spark, sf).where("type = 'callreg'").select(
        "service", "user", "day",
        F.coalesce("destination_number", F.lit("")).alias("number")).distinct()


QUERIES = {
    "day_header": day_header,
    "latest_mark": latest_mark,
    "marks_other": marks_other,
    "marks_merge": marks_merge,
    "new_headers": new_headers,
    "mark_lookup": mark_lookup,
    "union_marks": union_marks,
    "distinct_rows": distinct_rows,
}

_HEADER = NEW_SQL + """, header as (
    select distinct service, "user", day as date, 'mobility' as data_type from new),
    latest as (select service, "user", max(date) as date, data_type from header
      group by service, "user", data_type),
    merged as (
      select service, "user", date, data_type from marks o where data_type = 'mobility'
        and not exists (select 1 from latest l where l.service = o.service and l."user" = o."user")
      union all select service, "user", date, data_type from latest)"""

ORACLES = {
    "day_header": _HEADER + " select * from header",
    "latest_mark": _HEADER + " select * from latest",
    "marks_other": _HEADER + " select * from marks where data_type <> 'mobility'",
    "marks_merge": _HEADER + " select * from merged",
    "union_marks": _HEADER + """ select * from merged
        union all select * from marks where data_type <> 'mobility'""",
    "new_headers": _HEADER + f"""
        select service, "user", date from header h where not exists (
          select 1 from dp where dp.service = h.service and dp."user" = h."user"
            and dp.day = h.date and dp.day < date '{STORED_BEFORE}')""",
    "mark_lookup": _HEADER + """
        select event_id, coalesce(mark, date '1970-01-01') as mark from dp left join (
          select service, "user", max(date) as mark from marks where data_type = 'mobility'
          group by service, "user") m using (service, "user")""",
    "distinct_rows": SQL + """
        select distinct service, "user", day, coalesce(destination_number, '') as number
        from dp where type = 'callreg'""",
}
