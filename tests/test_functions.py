import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from dayprints.functions import geo, sensors, student, time
from dayprints.sources import datapoints


def _one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize("text,expected", [
    ("2018-03-10 07:08:09 UTC", dt.datetime(2018, 3, 10, 7, 8, 9)),
    ("2018-03-10 07:08:09.123 UTC", dt.datetime(2018, 3, 10, 7, 8, 9, 123000)),
    ("not a time", None),
    ("", None),
])
def test_parse_ts(spark, text, expected):
    assert _one(spark, t=time.parse_ts(F.lit(text)))["t"] == expected


def test_unparsable_rows_are_counted(table):
    rows = table([("a", "x", "2018-03-10 07:08:09 UTC"), ("a", "y", "??"), ("b", "z", None)],
                 "service string, user string, creation_datetime string")
    assert datapoints.parsed(rows).count() == 1
    assert {r["service"]: r["rejected"] for r in datapoints.rejected(rows).collect()} == {
        "a": 1, "b": 1}


def test_millis(spark):
    ms = time.date_document_millis(F.lit('{"$date": 1530000000123}'))
    got = _one(spark, ms=ms, ts=time.from_millis(ms))
    assert got["ms"] == 1530000000123
    assert got["ts"] == dt.datetime(2018, 6, 26, 8, 0, 0, 123000)
    ts = F.lit("1969-12-31 23:59:59.999").cast("timestamp_ntz")
    assert _one(spark, m=time.epoch_millis(ts))["m"] == -1
    assert _one(spark, t=time.from_millis(F.lit(-1)))["t"] == dt.datetime(
        1969, 12, 31, 23, 59, 59, 999000)


@pytest.mark.parametrize("clock,slot,bin_", [
    ("00:00:00", 0, 1), ("00:29:59", 0, 6), ("00:30:00", 1, 7),
    ("23:54:59", 47, 287), ("23:55:00", 47, 288), ("23:59:59", 47, 288)])
def test_slot_and_bin(spark, clock, slot, bin_):
    ts = F.lit(f"2024-01-01 {clock}").cast("timestamp_ntz")
    got = _one(spark, slot=time.slot48(ts), bin=time.bin288(ts))
    assert (got["slot"], got["bin"]) == (slot, bin_)


def test_week_label_equals_monday_counted_weeks(spark):
    days = spark.sql("select explode(sequence(date'2016-01-01', date'2022-12-31')) as day")
    rows = days.select("day", F.year("day").alias("y"), F.weekofyear("day").alias("w"),
                       time.week_label(F.year("day"), F.weekofyear("day")).alias("label"),
                       time.week_start("day").alias("monday")).collect()
    for r in rows:
        first = dt.date(r["y"], 1, 1)
        first += dt.timedelta(days=(7 - first.weekday()) % 7)
        assert r["label"] == first + dt.timedelta(weeks=r["w"] - 1)
        assert r["monday"] == r["day"] - dt.timedelta(days=r["day"].weekday())


def test_home_distance(spark):
    got = _one(spark, zero=geo.home_distance_km(F.lit(0.0), F.lit(0.0)),
               one=geo.home_distance_km(F.lit(0.0), F.lit(1.0)))
    assert got["zero"] == 0
    assert got["one"] == pytest.approx(6373 * math.pi / 180)


def test_mercator_round_trip(spark):
    x, y = geo.to_mercator(F.lit(40.3), F.lit(-3.7))
    lat, lon = geo.from_mercator(x, y)
    got = _one(spark, lat=lat, lon=lon)
    assert (got["lat"], got["lon"]) == (pytest.approx(40.3), pytest.approx(-3.7))


def test_wifi_order(spark):
    wifis = F.array(*[F.lit(w) for w in ("a -45", "b -9", "c -60")])
    got = _one(spark, s=sensors.top_wifis(wifis, 2), t=sensors.top_wifis(wifis, 2, "text"))
    assert got["s"] == ["b", "a"]
    assert got["t"] == ["a", "c"]


def test_activity_ties_go_by_name(spark):
    activity = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("confidence"))
                         for n, c in (("still", 50.0), ("walking", 50.0), ("running", 10.0))])
    got = _one(spark, top=sensors.top_activity(activity), active=sensors.is_active(activity))
    assert (got["top"], got["active"]) == ("walking", 1)


@pytest.mark.parametrize("df,expected", [
    (1, 12.706204736), (2, 4.302652730), (5, 2.570581836), (30, 2.042272456),
    (120, 1.979930405), (2001, 1.961149), (100000, 1.959987708)])
def test_t_quantile(df, expected):
    assert student.t_quantile(df) == pytest.approx(expected, abs=2e-6 if df > 1000 else 1e-8)


def test_t_quantile_has_one_rule_for_all_sizes():
    assert student.t_quantile(1, 0.99999) == pytest.approx(63661.977, abs=1e-2)
    for df in (2_000, 2_001, 20_001):
        assert student._central(student.t_quantile(df), df) == pytest.approx(0.95, abs=1e-12)



def test_hops(spark):
    cases = {("leaf1", "leaf1"): 0, ("leaf1", "spine2"): 1, ("dr1", "leaf9"): 1, ("dr1", "dr2"): 1,
             ("dr1", "spine1"): 2, ("leaf1", "leaf2"): 2, ("spine1", "spine2"): 2, ("x", "y"): 2}
    for (a, b), hop in cases.items():
        assert _one(spark, h=sensors.hop_distance(F.lit(a), F.lit(b)))["h"] == hop
