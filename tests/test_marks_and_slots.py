import datetime as dt

import pytest
from pyspark.sql import functions as F

from dayprints.operators import filters, marks, slots

MARKS = "service string, user string, date date, data_type string"
POINTS = ("service string, user string, day date, ts timestamp_ntz, distance double, speed double, "
          "latitude double, longitude double, accuracy double, source string")


def _d(text):
    return dt.date.fromisoformat(text)


def _p(service, user, ts, distance=1.0, speed=1.0, lat=0.0, lon=0.0, accuracy=10.0, source="app"):
    return (service, user, _d(ts[:10]), ts, distance, speed, lat, lon, accuracy, source)


def test_incremental_boundaries_and_services(table):
    rows = table([_p("a", "u", f"2024-01-{d:02d} 10:00:00") for d in range(1, 32)]
                 + [_p("b", "u", f"2024-01-{d:02d} 10:00:00") for d in range(1, 32)]
                 + [_p("a", "late", "2024-01-05 10:00:00")], POINTS)
    stored = table([("a", "u", _d("2024-01-10"), "mobility"), ("a", "u", _d("2024-01-29"), "other"),
                    ("a", "late", _d("2024-02-10"), "mobility")], MARKS)
    got = marks.incremental(rows, stored, "mobility", "2024-01-31")
    days = {}
    for r in got.collect():
        days.setdefault((r["service"], r["user"]), set()).add(r["day"].day)
    assert days == {("a", "u"): set(range(11, 29)), ("b", "u"): set(range(1, 29))}
    closed = filters.settled(rows, "2024-01-31")
    assert closed.agg(F.max("day")).first()[0] == _d("2024-01-26")


def test_marks_move_on(table):
    old = table([("a", "u", _d("2024-01-10"), "mobility"), ("a", "v", _d("2024-01-05"), "mobility")],
                MARKS)
    header = table([("a", "u", _d("2024-01-11"), "mobility"), ("a", "u", _d("2024-01-12"), "mobility")],
                   MARKS)
    merged = marks.marks_merge(old, marks.latest_mark(header))
    assert sorted((r["user"], r["date"]) for r in merged.collect()) == [
        ("u", _d("2024-01-12")), ("v", _d("2024-01-05"))]
    assert marks.new_headers(header, header).count() == 0


def test_at_home_tie_and_majority(table):
    rows = table([_p("a", "u", "2024-01-01 10:00:00"), _p("a", "u", "2024-01-01 10:05:00", lat=1.0),
                  _p("a", "u", "2024-01-01 11:00:00", lat=1.0),
                  _p("a", "u", "2024-01-01 11:05:00", lat=1.0),
                  _p("a", "u", "2024-01-01 11:06:00")], POINTS)
    got = {r["slot"]: r["value"] for r in slots.at_home_slots(rows).collect()}
    assert got == {20: 1, 22: 0}
    folded = {r["slot"]: r["home"] for r in slots.fold_sources(slots.slot_base(rows)).collect()}
    assert folded == got


def test_vector_defaults(table):
    rows = table([_p("a", "u", "2024-01-01 00:00:00", distance=5.0),
                  _p("a", "u", "2024-01-01 00:31:00", distance=0.0)], POINTS)
    vector = slots.slot_vector(slots.distance_slots(rows), ["service", "user", "day", "source"], "mean")
    r = vector.first()
    assert (r["slot1"], r["slot2"], r["slot3"]) == (5.0, -1.0, -1.0)
    var = slots.slot_vector(slots.distance_var_slots(rows), ["service", "user", "day", "source"], "var")
    assert [var.first()[f"slot{i}"] for i in (1, 2, 48)] == [0.0, 0.0, 0.0]


def test_folded_moments_equal_direct_ones(table):
    rows = table([_p("a", "u", f"2024-01-01 10:0{i}:00", speed=float(i * i),
                     source=["garmin", "fitbit", "x"][i % 3]) for i in range(8)], POINTS)
    r = slots.fold_sources(slots.slot_base(rows)).first()
    assert r["speed_mean"] == pytest.approx(slots.speed_slots(rows).first()["value"])
    assert r["speed_var"] == pytest.approx(slots.speed_var_slots(rows).first()["value"])


def test_empty(table):
    none = table([], POINTS)
    vector = slots.slot_vector(slots.distance_slots(none), ["service", "user", "day", "source"], "mean")
    assert vector.count() == 0 and len(vector.columns) == 4 + 1 + 48
    assert marks.incremental(none, table([], MARKS), "mobility", "2024-01-31").count() == 0
