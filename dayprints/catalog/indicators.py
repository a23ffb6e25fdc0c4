"""Indicators of a user-day and statistics: A12, A13, A15-A18, W1, W7, J9."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints.catalog.common import AS_OF, GEO_SQL, SQL, points, rnd
from dayprints.operators import filters, indicators, marks
from dayprints.sources import events


def gyradius(spark, sf):
    rows = marks.incremental(filters.geo(points(spark, sf)), events.marks(spark, sf),
                             "clustering", AS_OF)
    return indicators.gyradius(rows).withColumn("gyradius", rnd("gyradius"))


def circadian(spark, sf):
    return indicators.circadian(points(spark, sf)).select(
        "user", "day", "acrophase_s", "acrophase", rnd("mesor").alias("mesor"),
        rnd("amplitude").alias("amplitude"))


def last_in_bin(spark, sf):
    return indicators.last_in_bin(filters.with_actigraphy(points(spark, sf))).where(
        "bin < 288").withColumn("level", rnd("level", 9))


def standing_periods(spark, sf):
    return indicators.standing_periods(points(spark, sf))


def _app_days(spark, sf):
    return indicators.daily_distance(points(spark, sf))


def _wearable_days(spark, sf):
    rows = points(spark, sf).where("event_type = 'view'")
    return rows.groupBy("user", "day").agg((F.sum("distance") / 1000).alias("km")).where("km > 0")


def daily_distance(spark, sf):
    return _app_days(spark, sf).withColumn("km", rnd("km"))


def _aligned(spark, sf):
    return indicators.tail_align(_app_days(spark, sf), _wearable_days(spark, sf))


def tail_align(spark, sf):
    return _aligned(spark, sf).withColumns(
        {"app_km": rnd("app_km"), "wearable_km": rnd("wearable_km")})


def source_means(spark, sf):
    return indicators.source_means(_aligned(spark, sf)).withColumns(
        {"app_mean": rnd("app_mean", 8), "wearable_mean": rnd("wearable_mean", 8)})


def perf_fit(spark, sf):
    """Each user's rows stand for one run: days covered and seconds spent."""
    runs = points(spark, sf).groupBy("user").agg(
        F.sum("distance").alias("seconds"), F.count_distinct("day").alias("days"))
    return indicators.perf_fit(runs).select(rnd("slope", 8).alias("slope"),
                                            rnd("intercept", 8).alias("intercept"))


def zscore(spark, sf):
    rows = events.table(spark, sf, "embeddings")
    return indicators.vector_zscore(rows, "vec_id", "embedding").withColumn("z", rnd("z"))


def zscore_global(spark, sf):
    """One mean and population deviation over all positions."""
    rows = events.table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode("embedding").alias("dim", "x"))
    rows = rows.withColumn("x", F.col("x").cast("double"))
    return indicators.zscore(rows, [], "x", ddof=0).select("vec_id", "dim", rnd("z").alias("z"))


QUERIES = {
    "gyradius": gyradius,
    "circadian": circadian,
    "last_in_bin": last_in_bin,
    "standing_periods": standing_periods,
    "daily_distance": daily_distance,
    "tail_align": tail_align,
    "source_means": source_means,
    "perf_fit": perf_fit,
    "zscore": zscore,
    "zscore_global": zscore_global,
}

_ALIGNED = SQL + """, app as (
      select "user", day, sum(distance) / 1000 as km from dp
      where speed < 3 and accuracy < 100 and distance > 0 group by all),
    wear as (
      select "user", day, sum(distance) / 1000 as km from dp where event_type = 'view'
      group by all having sum(distance) > 0),
    aligned as (
      select "user", back, app_km, wearable_km from
        (select "user", km as app_km, cast(row_number() over (partition by "user"
          order by day desc) as integer) as back from app) join
        (select "user", km as wearable_km, cast(row_number() over (partition by "user"
          order by day desc) as integer) as back from wear) using ("user", back))"""

_BINS = SQL + """, lv as (
      select "user", day, ts, event_id, cast(sod // 300 + 1 as integer) as bin,
        list_avg(actigraphy) / 16 / 10 / 9.81 as level
      from dp where actigraphy is not null and len(actigraphy) > 0),
    b as (select "user", day, bin, arg_max(level, {'t': ts, 'e': event_id}) as level
      from lv group by all)"""

ORACLES = {
    "gyradius": SQL + "," + events.MARKS_SQL + f"""
        select "user", day, round(sqrt(var_pop(longitude) + var_pop(latitude)), 6) as gyradius
        from dp left join (
          select service, "user", max(date) as mark from marks
          where data_type = 'clustering' group by service, "user") m using (service, "user")
        where {GEO_SQL} and day < date '{AS_OF}' - 2 and (mark is null or day > mark)
          and longitude <> -1 and latitude <> -1 group by "user", day""",
    "circadian": _BINS + """,
        k as (select i, 2 * pi() * i / 287 as th from range(288) t(i)),
        d as (select distinct "user", day from b),
        y as (select d."user", d.day, k.i, k.th, coalesce(b.level, 1) as y
          from d cross join k left join b on b."user" = d."user" and b.day = d.day and b.bin = k.i),
        s as (select "user", day, sum(y) as s0, sum(y * cos(th)) as s1, sum(y * sin(th)) as s2
          from y group by all),
        f as (select "user", day, (144.5 * s0 - s1) / 41615 as b0, (288 * s1 - s0) / 41615 as b1,
          s2 / 143.5 as b2 from s),
        g as (select "user", day, i, b0 + b1 * cos(th) + b2 * sin(th) as fit from f cross join k),
        m as (select "user", day, max(fit) as top, avg(fit) as mesor from g group by all),
        h as (select g."user", g.day, min(i) as i, any_value(top) as top, any_value(mesor) as mesor
          from g join m on g."user" = m."user" and g.day = m.day
          where fit >= top - 1e-12 group by all)
        select "user", day, cast(i * 300 as integer) as acrophase_s,
          strftime(timestamp '2000-01-01' + to_seconds(i * 300), '%H:%M:%S') as acrophase,
          round(mesor, 6) as mesor, round(top - mesor, 6) as amplitude from h""",
    "last_in_bin": _BINS + """
        select "user", day, bin, round(level, 9) as level from b where bin < 288""",
    "standing_periods": SQL + """, a as (
          select "user", day, ts, event_id, top_activity in ('tilting', 'walking', 'running') as act,
            hour(ts) * 60 + minute(ts) as mi from dp where top_activity is not null),
        r as (select *, row_number() over (partition by "user", day order by ts, event_id) -
            row_number() over (partition by "user", day, act order by ts, event_id) as isl from a),
        g as (select "user", day, act, isl, max(mi) - min(mi) as len from r group by all)
        select "user", day, cast(count(*) filter (where act and len >= 30) as integer)
          as active_periods from g group by all""",
    "daily_distance": _ALIGNED + ' select "user", day, round(km, 6) as km from app',
    "tail_align": _ALIGNED + """ select "user", back, round(app_km, 6) as app_km,
        round(wearable_km, 6) as wearable_km from aligned""",
    "source_means": _ALIGNED + """ select "user", round(avg(app_km), 8) as app_mean,
        round(avg(wearable_km), 8) as wearable_mean from aligned group by all""",
    "perf_fit": SQL + """, r as (
          select "user", sum(distance) as seconds, count(distinct day) as days from dp group by all)
        select round(regr_slope(ln(seconds / days), days), 8) as slope,
          round(regr_intercept(ln(seconds / days), days), 8) as intercept from r""",
    "zscore": """with e as (
          select vec_id, cast(generate_subscripts(embedding, 1) - 1 as integer) as dim,
            cast(unnest(embedding) as double) as x from embeddings)
        select vec_id, dim, round((x - avg(x) over (partition by dim)) /
          stddev_samp(x) over (partition by dim), 6) as z from e""",
    "zscore_global": """with e as (
          select vec_id, cast(generate_subscripts(embedding, 1) - 1 as integer) as dim,
            cast(unnest(embedding) as double) as x from embeddings),
        s as (select avg(x) as m, stddev_pop(x) as sd from e)
        select vec_id, dim, round((x - m) / sd, 6) as z from e, s""",
}
