"""Filters F1-F14."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints import schemas
from dayprints.catalog.common import (AS_OF, GEO_SQL, MOBILITY_SQL, NEW_SQL, SQL, new_rows,
                                      points)
from dayprints.functions.time import epoch_millis
from dayprints.operators import filters, social
from dayprints.sources import events

COLS = ["event_id", "service", "user", "day"]
COLS_SQL = 'event_id, service, "user", day'


def _kept(fn):
    return lambda spark, sf: fn(points(spark, sf)).select(*COLS)


def nested(points_df):
    """Datapoints in the document-store shape, every leaf as text."""
    text = lambda c: F.col(c).cast("string")
    ms = epoch_millis("ts").cast("string")
    return points_df.select(
        F.struct("user", "service",
                 F.concat(F.lit('{"$date": '), ms, F.lit("}")).alias("creation_date_time"),
                 F.lit("app").alias("acquisition_provenance")).alias("header"),
        F.struct(F.struct(text("distance").alias("distance"),
                          text("speed").alias("speed")).alias("attributes"),
                 F.struct(text("altitude").alias("altitude"),
                          text("accuracy").alias("accuracy")).alias("coordinates")).alias("body"))


def filter_positive(spark, sf):
    docs = nested(points(spark, sf))
    docs = docs.select(F.from_json(F.to_json(F.struct("*")), schemas.NESTED).alias("d")).select("d.*")
    return filters.positive(docs).select("service", "user", "ts", "distance", "speed")


def filter_place(spark, sf):
    return filters.place(points(spark, sf)).select(*COLS, "altitude")


def filter_type(spark, sf):
    rows = points(spark, sf)
    return (filters.calls(rows).select(*COLS, F.lit("call").alias("kind"))
            .unionByName(filters.with_actigraphy(rows).select(*COLS, F.lit("actigraphy").alias("kind")))
            .unionByName(filters.with_activity(rows).select(*COLS, F.lit("activity").alias("kind"))))


def filter_launcher(spark, sf):
    return filters.launcher(social.app_rows(points(spark, sf)).select(
        "event_id", "app", F.floor(F.col("duration") / 1000).alias("time")))


QUERIES = {
    "filter_mobility": _kept(filters.mobility),
    "filter_geo": _kept(filters.geo),
    "filter_stationary": _kept(filters.stationary),
    "filter_type": filter_type,
    "filter_sentinel": _kept(filters.no_sentinel),
    "filter_app_distance": _kept(filters.app_distance),
    "filter_positive": filter_positive,
    "incremental": lambda spark, sf: new_rows(spark, sf).select(*COLS),
    "settled": _kept(lambda df: filters.settled(filters.mobility(df), AS_OF)),
    "filter_since": _kept(lambda df: filters.since(filters.calls(df), events.SINCE)),
    "filter_launcher": filter_launcher,
    "filter_moving": _kept(filters.moving),
    "filter_service": _kept(lambda df: filters.service(df, "svc1")),
    "filter_place": filter_place,
}

_SELECT = SQL + f" select {COLS_SQL} from dp where "

ORACLES = {
    "filter_mobility": _SELECT + MOBILITY_SQL,
    "filter_geo": _SELECT + GEO_SQL,
    "filter_stationary": _SELECT + GEO_SQL + " and speed < 0.5",
    "filter_type": SQL + f"""
        select {COLS_SQL}, 'call' as kind from dp where type = 'callreg'
        union all select {COLS_SQL}, 'actigraphy' from dp where event_type <> 'signup'
        union all select {COLS_SQL}, 'activity' from dp where event_type <> 'error'""",
    "filter_sentinel": _SELECT + "longitude <> -1 and latitude <> -1",
    "filter_app_distance": _SELECT + "speed < 3 and accuracy < 100 and distance > 0 "
                                     "and day <> date '1970-01-01'",
    "filter_positive": SQL + """
        select service, "user", date_trunc('millisecond', ts) as ts, distance, speed
        from dp where distance > 0 and speed > 0 and accuracy < 200""",
    "incremental": NEW_SQL + f" select {COLS_SQL} from new",
    "settled": _SELECT + MOBILITY_SQL + f" and day < date '{AS_OF}' - 4",
    "filter_since": _SELECT + f"type = 'callreg' and day > date '{events.SINCE}'",
    "filter_launcher": SQL + """
        select event_id, app, time from (
          select event_id, app, app_ms // 1000 as time from dp
          union all select event_id, 'maps', ((event_id * 97) % 3000) // 1000 from dp)
        where not contains(app, 'launcher') and time <> 0""",
    "filter_moving": _SELECT + "longitude <> -1 and latitude <> -1 and accuracy < 100 "
                               "and speed < 270",
    "filter_service": _SELECT + "service = 'svc1'",
    "filter_place": SQL + f"""
        select {COLS_SQL}, case when altitude = 0 then 600::double else altitude end as altitude
        from dp where longitude <> -1 and latitude <> -1 and accuracy < 90 and speed < 0.5""",
}
