"""Scalar functions C1-C19."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints.catalog.common import HAVERSINE_SQL, HOME_KM_SQL, SOURCE_SQL, SQL, points, rnd
from dayprints.functions import geo, sensors, time
from dayprints.operators import filters
from dayprints.sources import datapoints


def parse_ts(spark, sf):
    rows = points(spark, sf).drop("ts", "day").withColumn(
        "ms_text", F.concat(F.lit('{"$date":'), time.epoch_millis(F.expr(
            "cast(substring(creation_datetime, 1, 19) as timestamp_ntz)")).cast("string"), F.lit("}")))
    return datapoints.parsed(rows).select(
        "event_id", "ts", time.from_millis(time.date_document_millis("ms_text")).alias("ts_ms"))


def rotate_translate(spark, sf):
    x, y = geo.rotate_translate("longitude", "latitude")
    return points(spark, sf).select("event_id", rnd(x).alias("x"), rnd(y).alias("y"))


def web_mercator(spark, sf):
    x, y = geo.to_mercator("latitude", "longitude")
    rows = points(spark, sf).select("event_id", x.alias("x"), y.alias("y"))
    lat, lon = geo.from_mercator("x", "y")
    return rows.select("event_id", rnd("x", 3).alias("x"), rnd("y", 3).alias("y"),
                       rnd(lat, 7).alias("lat"), rnd(lon, 7).alias("lon"))


def week_key(spark, sf):
    return points(spark, sf).select(
        "event_id", time.week_year("day").alias("year"), time.iso_week("day").alias("week"),
        time.week_start("day").alias("monday"),
        time.week_label(F.year("day"), F.weekofyear("day")).alias("label"))


def week_label(spark, sf):
    """Labels over years of order dates, where the two week counts drift apart."""
    from dayprints.sources.events import table
    d = F.to_date("o_orderdate")
    return (table(spark, sf, "orders").select(d.alias("day")).distinct().select(
        "day", time.week_label(F.year("day"), F.weekofyear("day")).alias("label")))


def parse_wifi(spark, sf):
    return (points(spark, sf).where("wifis is not null")
            .select("event_id", F.inline(sensors.wifi_scan("wifis"))))


def hop_distance(spark, sf):
    other = F.expr("concat(case event_id % 3 when 0 then 'leaf' when 1 then 'spine' else 'dr' end, "
                   "cast(event_id % 6 as string))")
    return points(spark, sf).select("event_id", "node", other.alias("other"),
                                    sensors.hop_distance("node", other).alias("hop"))


def tag_place(spark, sf):
    rows = filters.stationary(points(spark, sf)).where("places is not null")
    return rows.select("user", time.epoch_seconds("ts").alias("epoch_s"), "longitude", "latitude",
                       F.concat_ws(",", F.col("places")[0]["placetype"].cast("array<string>"))
                       .alias("placetype"))


def _cols(*build):
    return lambda spark, sf: points(spark, sf).select("event_id", *[b() for b in build])


def actigraphy_scale(spark, sf):
    rows = filters.with_actigraphy(points(spark, sf))
    return (rows.select("event_id", rnd(sensors.actigraphy_level("actigraphy"), 9).alias("level"))
            .where("level is not null"))


def allowed_places(spark, sf):
    rows = points(spark, sf).where("places is not null")
    return rows.select(
        "event_id", F.concat_ws(",", sensors.allowed_places("places").cast("array<string>"))
        .alias("allowed"), sensors.first_allowed_place("places").alias("first_place")
    ).where("first_place is not null")


QUERIES = {
    "parse_ts": parse_ts,
    "slot48": _cols(lambda: time.slot48("ts").alias("slot")),
    "bin288": lambda spark, sf: points(spark, sf).select(
        "event_id", time.bin288("ts").alias("bin")).where(f"bin < {time.BINS}"),
    "week_key": week_key,
    "week_label": week_label,
    "home_distance": _cols(lambda: rnd(geo.home_distance_km("latitude", "longitude")).alias("km")),
    "rotate_translate": rotate_translate,
    "web_mercator": web_mercator,
    "sec_to_time": _cols(lambda: time.time_text(time.second_of_day("ts")).alias("time")),
    "actigraphy_scale": actigraphy_scale,
    "parse_wifi": parse_wifi,
    "allowed_places": allowed_places,
    "source_label": _cols(lambda: sensors.source_label("source").alias("source")),
    "hop_distance": hop_distance,
    "ms_to_s": _cols(lambda: time.ms_to_s("app_ms").alias("seconds")),
    "decay": _cols(lambda: rnd(geo.decay(1e-5, F.col("event_id") % 5000), 9).alias("weight")),
    "km_to_eps": _cols(lambda: rnd(geo.km_to_eps("distance"), 9).alias("eps")),
    "top_activity": lambda spark, sf: filters.with_activity(points(spark, sf)).select(
        "event_id", sensors.top_activity("activity").alias("activity"),
        sensors.is_active("activity").alias("active")),
    "tag_place": tag_place,
    "epoch_seconds": _cols(lambda: time.epoch_seconds("ts").alias("epoch_s")),
}

# Monday-counted week label: first Monday of the year plus (week - 1) weeks
LABEL_SQL = """cast(make_date(yr, 1, 1) + cast((8 - isodow(make_date(yr, 1, 1))) % 7 as integer)
               + cast((wk - 1) * 7 as integer) as date)"""

ORACLES = {
    "parse_ts": SQL + """
        select event_id, case when event_id % 2 = 0 then date_trunc('millisecond', ts)
          else date_trunc('second', ts) end as ts, date_trunc('second', ts) as ts_ms from dp""",
    "slot48": SQL + " select event_id, cast(sod // 1800 as integer) as slot from dp",
    "bin288": SQL + """ select event_id, cast(sod // 300 + 1 as integer) as bin from dp
        where sod // 300 + 1 < 288""",
    "week_key": SQL + f""", w as (
          select *, cast(year(day) as integer) as yr, cast(weekofyear(day) as integer) as wk
          from dp)
        select event_id, yr as year, wk as week, cast(date_trunc('week', day) as date) as monday,
          {LABEL_SQL} as label from w""",
    "week_label": f"""with w as (
          select distinct cast(o_orderdate as date) as day, cast(year(o_orderdate) as integer) as yr,
            cast(weekofyear(o_orderdate) as integer) as wk from orders)
        select day, {LABEL_SQL} as label from w""",
    "home_distance": SQL + f""", h as (select event_id, {HAVERSINE_SQL} as hv from dp)
        select event_id, round({HOME_KM_SQL}, 6) as km from h""",
    "rotate_translate": SQL + """
        select event_id,
          round(longitude * cos(radians(199)) - latitude * sin(radians(199)) - 3.77, 6) as x,
          round(longitude * sin(radians(199)) + latitude * cos(radians(199)) + 40.332, 6) as y
        from dp""",
    "web_mercator": SQL + """, m as (
          select event_id, longitude * (pi() * 6378137) / 180 as x,
            ln(tan((90 + latitude) * pi() / 360)) / (pi() / 180) * (pi() * 6378137) / 180 as y
          from dp)
        select event_id, round(x, 3) as x, round(y, 3) as y,
          round(180 / pi() * (2 * atan(exp(y / (pi() * 6378137) * pi())) - pi() / 2), 7) as lat,
          round(x / (pi() * 6378137) * 180, 7) as lon from m""",
    "sec_to_time": SQL + " select event_id, strftime(ts, '%H:%M:%S') as time from dp",
    "actigraphy_scale": SQL + """
        select event_id, round(list_avg(actigraphy) / 16 / 10 / 9.81, 9) as level from dp
        where actigraphy is not null and len(actigraphy) > 0""",
    "parse_wifi": SQL + """, w as (select event_id, unnest(wifi) as w from dp)
        select event_id, w.h as hash, '-' || w.p as power_text, cast(-w.p as integer) as power
        from w""",
    "allowed_places": SQL + """, a as (
          select event_id, list_filter(placetype, lambda t: t in (3, 4, 9, 13, 15, 23, 27, 45, 48)) as al
          from dp where placetype is not null)
        select event_id, array_to_string(al, ',') as allowed,
          cast(al[1] as integer) as first_place from a where len(al) > 0""",
    "source_label": SQL + f" select event_id, {SOURCE_SQL} as source from dp",
    "hop_distance": SQL + """, n as (
          select event_id, node, (case event_id % 3 when 0 then 'leaf' when 1 then 'spine'
            else 'dr' end) || (event_id % 6) as other from dp),
        t as (select *, regexp_extract(node, '[a-z]+') as a, regexp_extract(other, '[a-z]+') as b
          from n)
        select event_id, node, other, cast(case when node = other then 0
          when a || b in ('leafspine', 'spineleaf', 'leafdr', 'drleaf', 'drdr') then 1
          else 2 end as integer) as hop from t""",
    "ms_to_s": SQL + " select event_id, app_ms // 1000 as seconds from dp",
    "decay": SQL + """ select event_id,
        round(pow(2::double, -1e-5::double * (event_id % 5000)), 9) as weight from dp""",
    "km_to_eps": SQL + " select event_id, round(distance / 6371, 9) as eps from dp",
    "top_activity": SQL + """
        select event_id, top_activity as activity, cast(case when top_activity in
          ('tilting', 'walking', 'running') then 1 else 0 end as integer) as active
        from dp where top_activity is not null""",
    "tag_place": SQL + """
        select "user", cast(floor(epoch(ts)) as bigint) as epoch_s, longitude, latitude,
          array_to_string(placetype, ',') as placetype
        from dp where accuracy < 200 and speed < 0.5 and placetype is not null""",
    "epoch_seconds": SQL + " select event_id, cast(floor(epoch(ts)) as bigint) as epoch_s from dp",
}
