"""Calls, applications and places: A9-A11, A14, J5, E2, E3."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints.catalog.common import AS_OF, SQL, points, rnd
from dayprints.catalog.functions import LABEL_SQL
from dayprints.operators import filters, marks, social
from dayprints.sources import events


def _calls(spark, sf):
    """Call rows of the incremental run."""
    return marks.incremental(filters.calls(points(spark, sf)), events.marks(spark, sf),
                             "mobility", AS_OF)


def outgoing_pct(spark, sf):
    return social.outgoing_pct(_calls(spark, sf))


def outgoing_pct_published(spark, sf):
    return social.outgoing_pct(_calls(spark, sf), label="published")


def contact_entropy(spark, sf):
    return social.contact_entropy(_calls(spark, sf), events.SINCE).withColumn(
        "entropy", rnd("entropy", 9))


def contact_entropy_shannon(spark, sf):
    return social.contact_entropy_shannon(_calls(spark, sf), events.SINCE).withColumn(
        "entropy", rnd("entropy", 9))


def call_weeks(spark, sf):
    return social.call_weeks(_calls(spark, sf), events.SINCE).withColumn(
        "entropy", rnd(F.coalesce("entropy", F.lit(-1.0)), 9))


def app_usage(spark, sf):
    return social.app_usage(points(spark, sf))


def calls_apps_outer(spark, sf):
    return social.calls_apps_outer(_calls(spark, sf), app_usage(spark, sf))


def social_places(spark, sf):
    return social.social_places(filters.stationary(points(spark, sf)))


def collect_per_key(spark, sf):
    """Distances of a user-day in time order, as text of the list pieces."""
    rows = social.collect_per_key(points(spark, sf), ["user", "day"], ["ts", "event_id"],
                                  F.col("duration"))
    return rows.select("user", "day", "piece",
                       F.concat_ws(",", F.col("values").cast("array<string>")).alias("listed"))


def zip_explode(spark, sf):
    arrays = points(spark, sf).select(
        "event_id", F.col("apps")["name"].alias("app"),
        F.transform(F.col("apps")["duration"], lambda d: F.floor(d / 1000)).alias("time"))
    return social.zip_explode(arrays, "app", "time")


def flatten_apps(spark, sf):
    return social.app_rows(points(spark, sf)).select("event_id", "app", "duration")


def call_register(spark, sf):
    return social.call_register(_calls(spark, sf)).fillna({"number": ""})


QUERIES = {
    "outgoing_pct": outgoing_pct,
    "outgoing_pct_published": outgoing_pct_published,
    "contact_entropy": contact_entropy,
    "contact_entropy_shannon": contact_entropy_shannon,
    "call_weeks": call_weeks,
    "call_register": call_register,
    "app_usage": app_usage,
    "calls_apps_outer": calls_apps_outer,
    "social_places": social_places,
    "collect_per_key": collect_per_key,
    "zip_explode": zip_explode,
    "flatten_apps": flatten_apps,
}

_CALLS = SQL + "," + events.MARKS_SQL + f""",
    calls as (
      select dp.*, cast(date_trunc('week', day) as date) as week,
        cast(year(day) as integer) as yr, cast(weekofyear(day) as integer) as wk,
        coalesce(destination_number, '') as number
      from dp left join (
        select service, "user", max(date) as mark from marks
        where data_type = 'mobility' group by service, "user") m using (service, "user")
      where type = 'callreg' and day < date '{AS_OF}' - 2 and (mark is null or day > mark)),
    recent as (select * from calls where day > date '{events.SINCE}')"""

_APPS = """, a as (
      select service, "user", day, ts, event_id, app, app_ms as ms from dp
      union all
      select service, "user", day, ts, event_id, 'maps', (event_id * 97) % 3000 from dp),
    usage as (
      select service, "user", day, cast(hour(ts) * 2 + minute(ts) // 30 as integer) as slot, app,
        cast(sum(ms) // 1000 as bigint) as time
      from a group by all
      having not contains(app, 'launcher') and sum(ms) // 1000 <> 0)"""

_PCT = ("cast(count(*) filter (where call_type = 'OUTGOING') * 100 // count(*) as integer) "
        "as outgoing_pct")

ORACLES = {
    "outgoing_pct": _CALLS + f' select service, "user", week, {_PCT} from calls group by all',
    "outgoing_pct_published": _CALLS + f"""
        select service, "user", week, outgoing_pct from (
          select service, "user", yr, wk, {LABEL_SQL} as week, {_PCT} from calls
          group by service, "user", yr, wk)""",
    "contact_entropy": _CALLS + """
        select service, "user", week, round(log2(count(distinct number)), 9) as entropy
        from recent group by all""",
    "contact_entropy_shannon": _CALLS + """, n as (
          select service, "user", week, number, count(*) as n from recent group by all),
        t as (select *, sum(n) over (partition by service, "user", week) as total from n)
        select service, "user", week, round(-sum(n / total * log2(n / total)), 9) + 0 as entropy
        from t group by all""",
    "call_weeks": _CALLS + f"""
        select service, "user", week, {_PCT}, round(coalesce(log2(nullif(count(distinct number)
          filter (where day > date '{events.SINCE}'), 0)), -1), 9) as entropy from calls group by all""",
    "call_register": _CALLS + """
        select strftime(ts, '%H:%M:%S') as time, duration, number,
          call_type as type, service, "user", day from calls""",
    "app_usage": SQL + _APPS + " select * from usage",
    "calls_apps_outer": _CALLS + _APPS + """
        select service, "user", day, coalesce(c.calls, 0) as calls, coalesce(u.app_rows, 0) as app_rows
        from (select service, "user", day, count(*) as calls from calls group by all) c
        full join (select service, "user", day, count(*) as app_rows from usage group by all) u
          using (service, "user", day)""",
    "social_places": SQL + """, p as (
          select *, cast(date_trunc('week', day) as date) as week,
            list_filter(placetype, lambda t: t in (3, 4, 9, 13, 15, 23, 27, 45, 48)) as al
          from dp where accuracy < 200 and speed < 0.5)
        select "user", week, row_number() over (partition by "user", week order by ts, event_id)
          as pos, cast(al[1] as integer) as place from p where len(al) > 0""",
    "collect_per_key": SQL + """
        select "user", day, piece, string_agg(duration, ',' order by ts, event_id) as listed
        from (select *, (row_number() over (partition by "user", day order by ts, event_id) - 1)
          // 10000 as piece from dp) group by "user", day, piece""",
    "zip_explode": SQL + """
        select event_id, app, app_ms // 1000 as time from dp
        union all select event_id, 'maps', ((event_id * 97) % 3000) // 1000 from dp""",
    "flatten_apps": SQL + """
        select event_id, app, app_ms as duration from dp
        union all select event_id, 'maps', (event_id * 97) % 3000 from dp""",
}
