"""Shared pieces of the catalog modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayprints.operators import filters, marks
from dayprints.session import scratch_path
from dayprints.sources import events

AS_OF = events.AS_OF
SQL = events.SQL

MOBILITY_SQL = ("distance is not null and speed is not null and latitude is not null "
                "and longitude is not null and accuracy < 200")
GEO_SQL = ("longitude > -180 and longitude < 180 and latitude > -90 and latitude < 90 "
           "and accuracy < 200")

# rows of the mobility job: filtered, after the user's mark, closed two days ago
NEW_SQL = (SQL + "," + events.MARKS_SQL + f""",
    new as (
      select dp.*, hour(ts) * 2 + minute(ts) // 30 as slot0
      from dp left join (
        select service, "user", max(date) as mark from marks
        where data_type = 'mobility' group by service, "user") m using (service, "user")
      where {MOBILITY_SQL} and day < date '{AS_OF}' - 2 and (mark is null or day > mark))""")

SOURCE_SQL = "case when source in ('garmin', 'fitbit', 'googlefit') then source else 'app' end"

# great-circle km to the origin, as the at-home test needs it
HOME_KM_SQL = ("(2 * 6373.0::double * atan2(sqrt(hv), sqrt(1 - hv)))")
HAVERSINE_SQL = ("pow(sin(radians(latitude) / 2), 2) + "
                 "cos(radians(latitude)) * pow(sin(radians(longitude) / 2), 2)")


def points(spark, sf) -> DataFrame:
    return events.datapoints(spark, sf)


def new_rows(spark, sf) -> DataFrame:
    rows = filters.mobility(points(spark, sf))
    return marks.incremental(rows, events.marks(spark, sf), "mobility", AS_OF)


def rnd(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def stage_json(df: DataFrame, name: str) -> str:
    """Write rows as JSON lines to the shared folder for a reader to read."""
    path = scratch_path(df.sparkSession, name)
    df.write.json(path)
    return path
