"""Ordered logic, sorts and limits: W3-W6, W8, A20, L1-L3, E1, J6."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayprints.catalog.common import SQL, points, rnd
from dayprints.functions import sensors
from dayprints.operators import filters, trajectory, wifi
from dayprints.sources import events


def step_distance(spark, sf):
    rows = filters.moving(points(spark, sf)).select("event_id", "user", "ts", "longitude", "latitude")
    return trajectory.step_distance(rows, ["user"]).select("event_id", rnd("step").alias("step"))


def haar_detail(spark, sf):
    rows = filters.moving(points(spark, sf)).select("event_id", "user", "ts", "longitude", "latitude")
    return trajectory.haar_detail(
        rows, ["user"], trajectory.step, trajectory.POSITION, reach=1).select(
        "event_id", rnd("detail").alias("detail"), rnd("smooth").alias("smooth"))


def tail_slice(spark, sf):
    rows = filters.moving(points(spark, sf)).select(
        "service", "event_id", "ts", "longitude", "latitude", "speed")
    return trajectory.tail_slice(rows, ["service"]).drop("back")


def sample_gap(spark, sf):
    rows = points(spark, sf).select("node", "event_id", "ts")
    return trajectory.sample_gap(rows, ["node"]).select("event_id", "node", "gap_ms")


def interval_hist(spark, sf):
    return trajectory.interval_hist(sample_gap(spark, sf), ["node"])


def _scans(spark, sf):
    return points(spark, sf).where("wifis is not null")


def top5_wifi(spark, sf):
    return _scans(spark, sf).select(
        "event_id", F.concat_ws(",", sensors.top_wifis("wifis")).alias("strongest"),
        F.concat_ws(",", sensors.top_wifis("wifis", order="text")).alias("as_text"))


def wifi_multihot(spark, sf):
    return wifi.multihot(_scans(spark, sf), ["user"])


def wifi_vectors(spark, sf):
    rows = wifi.dense_vectors(_scans(spark, sf), ["user"])
    return rows.select("user", "event_id", F.concat_ws(
        "", F.col("vector").cast("array<string>")).alias("vector"))


def wifi_within_60s(spark, sf):
    """Positions of a service with the nearest wifi scan; empty text if there is none.

    A position that carries wifi itself finds a scan of its own time.
    """
    positions = points(spark, sf).select("service", "event_id", "ts")
    out = wifi.nearest_scan(positions, _scans(spark, sf), ["service"],
                            F.struct("event_id", sensors.top_wifis("wifis").alias("hashes")))
    return out.select("event_id", F.coalesce("scan.payload.event_id", F.lit(-1)).alias("scan_id"),
                      F.coalesce(F.concat_ws(",", "scan.payload.hashes"), F.lit("")).alias("hashes"))


QUERIES = {
    "step_distance": step_distance,
    "haar_detail": haar_detail,
    "tail_slice": tail_slice,
    "sample_gap": sample_gap,
    "interval_hist": interval_hist,
    # the id splits ranges of equal texts
    "sort_values": lambda spark, sf: events.table(spark, sf, "documents").select(
        "doc_id", "text").orderBy("text", "doc_id"),
    "sort_recent": lambda spark, sf: points(spark, sf).select("event_id", "ts").orderBy(
        F.col("ts").desc(), F.col("event_id").desc()),
    "take_n": lambda spark, sf: points(spark, sf).select("event_id", "user", "ts").orderBy(
        F.col("ts").desc(), F.col("event_id").desc()).limit(20),
    "top5_wifi": top5_wifi,
    "wifi_multihot": wifi_multihot,
    "wifi_vectors": wifi_vectors,
    "wifi_within_60s": wifi_within_60s,
}

_STEPS = SQL + """, m as (
      select * from dp where longitude <> -1 and latitude <> -1 and accuracy < 100 and speed < 270),
    s as (
      select *, sqrt(pow(longitude - lag(longitude) over w, 2) +
        pow(latitude - lag(latitude) over w, 2)) as step
      from m window w as (partition by "user" order by ts, event_id)),
    st as (select * from s where step is not null)"""

_GAPS = SQL + """, g as (
      select event_id, node, epoch_us(ts) // 1000 - epoch_us(lag(ts) over (
        partition by node order by ts, event_id)) // 1000 as gap_ms from dp),
    gap as (select * from g where gap_ms is not null)"""

_TOP5 = SQL + """, sc as (
      select event_id, service, "user", ts,
        list_transform(list_sort(list_transform(wifi, lambda w: {'k': w.p, 'h': w.h}))[1:5],
          lambda w: w.h) as top,
        list_transform(list_sort(list_transform(wifi, lambda w: {'k': '-' || w.p, 'h': w.h}))[1:5],
          lambda w: w.h) as top_text
      from dp where wifi is not null)"""

_VOCABULARY = _TOP5 + """, hs as (
      select "user", event_id, ts, unnest(top) as hash, generate_subscripts(top, 1) as pos from sc),
    fs as (select "user", hash, min({'t': ts, 'e': event_id, 'p': pos}) as seen from hs group by all),
    vo as (select "user", hash, cast(row_number() over (partition by "user" order by seen) - 1
      as integer) as idx from fs)"""

ORACLES = {
    "step_distance": _STEPS + " select event_id, round(step, 6) as step from st",
    "haar_detail": _STEPS + """, n as (
          select event_id, step as x,
            coalesce(lag(step) over w, last_value(step) over f) as b,
            coalesce(lead(step) over w, first_value(step) over f) as a
          from st window w as (partition by "user" order by ts, event_id),
            f as (partition by "user" order by ts, event_id
              rows between unbounded preceding and unbounded following))
        select event_id, round(abs((2 * x - b - a) / 4), 6) as detail,
          round(abs((2 * x + b + a) / 4), 6) as smooth from n""",
    "tail_slice": SQL + """, b as (
          select *, row_number() over (partition by service order by ts desc, event_id desc) as back
          from dp where longitude <> -1 and latitude <> -1 and accuracy < 100 and speed < 270)
        select service, event_id, ts, longitude, latitude, speed from b
        where back <= 1100 and back > 900""",
    "sample_gap": _GAPS + " select event_id, node, gap_ms from gap",
    "interval_hist": _GAPS + """, e as (
          select *, min(gap_ms) over (partition by node) as lo,
            max(gap_ms) over (partition by node) as hi from gap)
        select node, cast(least((gap_ms - lo) * 15 // greatest(hi - lo, 1), 14) as integer) as bin,
          count(*) as n from e group by all""",
    "sort_values": "select doc_id, text from documents order by text, doc_id",
    "sort_recent": "select event_id, ts from events order by ts desc, event_id desc",
    "take_n": SQL + """ select event_id, "user", ts from dp
        order by ts desc, event_id desc limit 20""",
    "top5_wifi": _TOP5 + """ select event_id, array_to_string(top, ',') as strongest,
        array_to_string(top_text, ',') as as_text from sc""",
    "wifi_multihot": _VOCABULARY + """
        select "user", event_id, idx from hs join vo using ("user", hash)""",
    "wifi_vectors": _VOCABULARY + """,
        o as (select "user", event_id, list(idx) as ones from hs join vo using ("user", hash)
          group by all),
        z as (select "user", max(idx) + 1 as size from vo group by all)
        select "user", event_id, array_to_string(list_transform(range(size),
          lambda i: case when list_contains(ones, i) then 1 else 0 end), '') as vector
        from o join z using ("user")""",
    "wifi_within_60s": _TOP5 + """, p as (
          select service, event_id, epoch_us(ts) // 1000 as t from dp),
        c as (
          select p.event_id, s.event_id as scan_id, s.top, epoch_us(s.ts) // 1000 as st, p.t
          from p join sc s on s.service = p.service and abs(epoch_us(s.ts) // 1000 - p.t) <= 60000),
        b as (select *, row_number() over (partition by event_id order by abs(st - t), st > t,
          case when st > t then scan_id else -scan_id end) as rn from c)
        select p.event_id, coalesce(b.scan_id, -1) as scan_id,
          coalesce(array_to_string(b.top, ','), '') as hashes
        from p left join b on b.event_id = p.event_id and rn = 1""",
}
