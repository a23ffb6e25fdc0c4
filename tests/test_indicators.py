import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayprints.operators import indicators, social, trajectory, wifi

ACT = ("user string, day date, ts timestamp_ntz, event_id bigint, "
       "activity array<struct<name:string,confidence:double>>")
DAY = dt.date(2024, 1, 1)


def _act(minute, active, i, user="u"):
    name = "walking" if active else "still"
    return (user, DAY, f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00", i, [(name, 1.0)])


def test_standing_periods_run_lengths(table):
    plan = [(0, 1), (29, 1), (40, 0), (100, 1), (115, 1), (130, 1), (131, 0), (200, 1), (231, 1)]
    rows = [_act(m, a, i) for i, (m, a) in enumerate(plan)]
    rows += [_act(10, 0, 100, "idle"), _act(50, 0, 101, "idle")]
    got = {r["user"]: r["active_periods"]
           for r in indicators.standing_periods(table(rows, ACT)).collect()}
    assert got == {"u": 2, "idle": 0}


def test_circadian_equals_least_squares(spark, table):
    rng = np.random.default_rng(3)
    rows, truth = [], {}
    for u in range(6):
        y = np.ones(288)
        for i, second in enumerate(sorted(rng.integers(0, 86400, 5 + 30 * u))):
            samples = rng.integers(0, 900, 4)
            rows.append((str(u), DAY, f"2024-01-01 {second // 3600:02d}:{second % 3600 // 60:02d}:"
                         f"{second % 60:02d}", u * 1000 + i, [str(s) for s in samples]))
            if second // 300 + 1 < 288:
                y[second // 300 + 1] = samples.mean() / 16 / 10 / 9.81
        a = 2 * math.pi / 24 * np.linspace(0, 24, 288)
        x = np.column_stack([np.ones(288), np.cos(a), np.sin(a)])
        fit = x @ np.linalg.lstsq(x, y, rcond=None)[0]
        truth[str(u)] = (int(np.argmax(fit)) * 300, fit.mean(), fit.max() - fit.mean())
    df = table(rows, "user string, day date, ts timestamp_ntz, event_id bigint, actigraphy array<string>")
    for r in indicators.circadian(df).collect():
        second, mesor, amplitude = truth[r["user"]]
        assert r["acrophase_s"] == second
        assert r["mesor"] == pytest.approx(mesor, abs=1e-9)
        assert r["amplitude"] == pytest.approx(amplitude, abs=1e-9)


def test_circadian_day_without_bins(table):
    df = table([("u", DAY, "2024-01-01 23:56:00", 1, ["5"])],
               "user string, day date, ts timestamp_ntz, event_id bigint, actigraphy array<string>")
    r = indicators.circadian(df).first()
    assert (r["acrophase"], r["mesor"], r["amplitude"]) == (
        "00:00:00", pytest.approx(1), pytest.approx(0, abs=1e-12))


CALLS = "service string, user string, day date, destination_number string, call_type string"


def test_calls(table):
    day = dt.date(2018, 12, 31)
    rows = [("s", "u", day, n, "INCOMING") for n in (None, None, "1", "2", "3")]
    calls = table(rows, CALLS)
    assert social.outgoing_pct(calls).first()["outgoing_pct"] == 0
    assert social.contact_entropy(calls, "2018-01-01").first()["entropy"] == 2.0
    assert social.contact_entropy(calls, "2018-01-01").first()["week"] == day
    # the published label takes ISO week 1 of 2018 for this day
    assert social.outgoing_pct(calls, "published").first()["week"] == dt.date(2018, 1, 1)
    assert social.contact_entropy(calls, "2019-01-01").count() == 0


def test_published_weeks_split_at_the_year(table):
    rows = [("s", "u", d, "1", "OUTGOING") for d in (dt.date(2018, 12, 31), dt.date(2019, 1, 1))]
    assert social.outgoing_pct(table(rows, CALLS), "published").count() == 2
    assert social.outgoing_pct(table(rows, CALLS)).count() == 1


def test_haar_ring(table):
    values = [1.0, 4.0, 2.0, 8.0, 5.0]
    rows = [("u", f"2024-01-01 {i * 5:02d}:00:00", i, v) for i, v in enumerate(values)]
    got = trajectory.haar_detail(table(rows, "user string, ts timestamp_ntz, event_id bigint, x double"),
                                 ["user"], "x").orderBy("event_id").collect()
    x = np.array(values)
    detail = np.abs(2 * x - np.roll(x, 1) - np.roll(x, -1)) / 4
    assert [r["detail"] for r in got] == pytest.approx(list(detail))


SCAN = "user string, ts timestamp_ntz, event_id bigint"


@pytest.mark.parametrize("scans,expected", [
    ([("2024-01-01 10:01:00", 1)], 1),          # exactly a minute later
    ([("2024-01-01 10:01:01", 1)], None),
    ([("2024-01-01 09:59:00", 1)], 1),
    ([("2024-01-01 09:59:30", 1), ("2024-01-01 10:00:30", 2)], 1),  # tie: earlier
    ([("2024-01-01 09:59:29", 1), ("2024-01-01 10:00:30", 2)], 2),
    ([("2024-01-01 10:00:00", 1)], 1),
    ([], None)])
def test_nearest_scan(table, scans, expected):
    points = table([("u", "2024-01-01 10:00:00", 100)], SCAN)
    found = table([("u", t, i) for t, i in scans] + [("other", "2024-01-01 10:00:00", 9)], SCAN)
    got = wifi.nearest_scan(points, found, ["user"], F.col("event_id")).first()["scan"]
    assert (got["payload"] if got else None) == expected


def test_nearest_scan_across_buckets_equals_brute_force(spark, table):
    rng = np.random.default_rng(5)
    stamp = lambda s: str(dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=int(s)))
    p, s = rng.integers(0, 5_000_000, 150), rng.integers(0, 5_000_000, 60)
    got = wifi.nearest_scan(table([("u", stamp(v), i) for i, v in enumerate(p)], SCAN),
                            table([("u", stamp(v), i) for i, v in enumerate(s)], SCAN),
                            ["user"], F.col("event_id")).collect()
    for r in got:
        gap = np.abs(s - p[r["event_id"]])
        if gap.min() > 60_000:
            assert r["scan"] is None
        else:
            assert r["scan"]["payload"] == int(np.argmin(gap))


def test_list_pieces_give_the_whole_list(spark):
    rows = spark.range(1000).select(
        F.lit("k").alias("k"), F.col("id").alias("event_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
            mins=((F.col("id") * 37) % 1000).cast("int"))).alias("ts")).repartition(5)
    got = social.collect_per_key(rows, ["k"], ["ts", "event_id"], F.col("event_id"), 64)
    pieces = [r["values"] for r in got.orderBy("piece").collect()]
    assert max(map(len, pieces)) == 64
    assert sum(pieces, []) == sorted(range(1000), key=lambda i: (i * 37) % 1000)


def test_a_busy_minute_of_scans_spreads(spark, monkeypatch):
    """Half of the points and scans of one key stand in a minute; several ranges share it."""
    from pyspark.sql import functions as F

    from dayprints.operators import wifi
    start = 1_704_067_200_000
    rows = spark.range(6_000).select(
        F.col("id").alias("event_id"), F.lit("u").alias("user"),
        F.timestamp_millis(F.lit(start) + F.when(F.col("id") % 2 == 0, F.col("id") * 10).otherwise(
            F.col("id") * 977 * 60)).cast("timestamp_ntz").alias("ts"))
    points, scans = rows.where("event_id % 5 > 0"), rows.where("event_id % 5 = 0")
    seen = []
    real = wifi.ranged

    def watched(df, keys, order):
        out = real(df, keys, order, ranges=64)
        seen.extend(r["count"] for r in out.groupBy("__range").count().collect())
        return out

    monkeypatch.setattr(wifi, "ranged", watched)
    got = {r["event_id"]: r["scan"] for r in wifi.nearest_scan(
        points, scans, ["user"], F.col("event_id")).collect()}
    assert len(seen) > 32 and max(seen) < 600
    at = {r["event_id"]: r["ts"] for r in rows.collect()}
    times = sorted((at[i], i) for i in at if i % 5 == 0)
    for i, scan in got.items():
        before = max((t for t in times if t[0] <= at[i]), default=None)
        after = min((t for t in times if t[0] >= at[i]), default=None)
        gaps = [(abs((t[0] - at[i]).total_seconds()), k, t[1])
                for k, t in enumerate((before, after)) if t]
        gap, _, scan_id = min(gaps)
        assert (scan["payload"] == scan_id) if gap <= 60 else scan is None


def test_nearest_scan_takes_no_frame_up_to_the_last_row(table):
    """Such a frame is summed up anew for each row: its time grows with the square of a range."""
    points = table([("u", "2024-01-01 10:00:00", 1)], SCAN)
    scans = table([("u", "2024-01-01 10:00:30", 2), ("u", "2024-01-01 10:00:30", 3),
                   ("u", "2024-01-01 10:00:40", 4)], SCAN)
    out = wifi.nearest_scan(points, scans, ["user"], F.col("event_id"))
    plan = out._jdf.queryExecution().analyzed().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan
    assert out.first()["scan"]["payload"] == 2  # the first of equal times behind the point
