import itertools
import math

import numpy as np
import pytest

from dayprints.functions.student import t_quantile
from dayprints.operators import evaluate

SAMPLES = "node string, ts timestamp_ntz, event_id bigint, result boolean"
EVENTS = "name string, start_ms bigint, end_ms bigint, node string, type string, online boolean"
CLEARS = "name string, start_ms bigint, end_ms bigint"


def _stamp(ms):
    return f"1970-01-01 {ms // 3_600_000:02d}:{ms // 60_000 % 60:02d}:{ms // 1000 % 60:02d}.{ms % 1000:03d}"


def _samples(table, node, flags, step=1000):
    return table([(node, _stamp(i * step), i, bool(f)) for i, f in enumerate(flags)], SAMPLES)


def brute(times, flags, start, end, open_start, k_max):
    """Run lengths and the time of the k-th row of the first long enough run, per k."""
    inside = [(i, t) for i, (t, f) in enumerate(zip(times, flags))
              if f and (t > start if open_start else t >= start) and t <= end]
    runs = []
    for _, group in itertools.groupby(enumerate(inside), lambda e: e[0] - e[1][0]):
        runs.append([t for _, (_, t) in group])
    first = {}
    for k in range(1, k_max + 1):
        long = [r for r in runs if len(r) >= k]
        first[k] = (long[0][k - 1] - start if long else None, len(long))
    return first


def test_runs_and_delays_equal_brute_force(table):
    rng = np.random.default_rng(8)
    flags = rng.random(400) < 0.6
    times = [i * 47_000 for i in range(400)]
    spans = [(0, 500_000), (470_000, 940_000), (1_000_000, 9_000_000), (18_800_000, 20_000_000)]
    samples = _samples(table, "leaf1", flags, 47_000)
    events = table([(f"e{i}", s, e, "leaf1", "single", True) for i, (s, e) in enumerate(spans)], EVENTS)
    clears = table([(f"c{i}", s, e) for i, (s, e) in enumerate(spans)], CLEARS)
    found = {(r["name"], r["k"]): r["delay_ms"]
             for r in evaluate.detections(samples, events, 5).collect()}
    false = {r["k"]: r["false_positives"]
             for r in evaluate.false_positives(samples, clears, 5).collect()}
    want = {i: brute(times, flags, *span, False, 5) for i, span in enumerate(spans)}
    assert found == {(f"e{i}", k): v[k][0] for i, v in want.items() for k in v if v[k][0] is not None}
    wanted_false = [brute(times, flags, *span, True, 5) for span in spans]
    assert false == {k: sum(w[k][1] for w in wanted_false) for k in range(1, 6)}
    total = evaluate.detection(samples, events, 5).where("k = 1").first()
    assert total["events"] == 4


def test_edges_of_intervals(table):
    samples = table([("n", _stamp(1000), 1, True), ("n", _stamp(2000), 2, True)], SAMPLES)
    span = table([("x", 1000, 2000)], CLEARS)
    inside = evaluate.flagged(samples)
    assert evaluate.interval_join(inside, span).count() == 2
    assert evaluate.interval_join(inside, span, open_start=True).count() == 1


def test_online_and_multiple_events_are_left_out(table):
    samples = _samples(table, "n", [1] * 10)
    events = table([("a", 0, 5000, "n", "single", True), ("b", 0, 5000, "n", "single", False),
                    ("c", 0, 5000, "n", "multiple", True)], EVENTS)
    at = lambda **kw: evaluate.detection(samples, events, 1, **kw).first()
    assert (at()["detections"], at()["events"]) == (2, 2)
    assert (at(online=True)["detections"], at(online=True)["events"]) == (1, 1)


def test_precision_recall_and_width(spark):
    detected = spark.createDataFrame([("a", 1, 3, 4), ("b", 1, 1, 4), ("c", 1, 0, 4)],
                                     "node string, k int, detections bigint, events bigint")
    false = spark.createDataFrame([("a", 1, 1), ("b", 1, 0), ("c", 1, 30)],
                                  "node string, k int, false_positives bigint")
    clears = spark.createDataFrame([("x", 0, 1)], CLEARS)
    r = evaluate.precision_recall(detected, false, clears).first()
    recall, precision = np.array([.75, .25, 0]), np.array([.75, 1.0])
    assert r["recall_mean"] == pytest.approx(recall.mean())
    assert r["recall_width"] == pytest.approx(
        t_quantile(2) * recall.std(ddof=1) / math.sqrt(3))
    assert r["precision_mean"] == pytest.approx(precision.mean())
    assert r["false_rate_mean"] == 1.0


def test_no_nested_loops_in_interval_join(table):
    samples = _samples(table, "n", [1] * 10)
    span = table([("x", 1000, 2000)], CLEARS)
    plan = evaluate.interval_join(evaluate.flagged(samples), span)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("granule", [1, 1000, 1 << 20])
def test_intervals_of_any_length_equal_a_range_test(spark, granule):
    rng = np.random.default_rng(granule)
    year = 366 * 86_400_000
    spans = [(0, year), (5, 5), (9, 3), (1 << 20, 1 << 21), (-7_000, 12_345), (999, 1000)]
    spans += [tuple(sorted(rng.integers(0, year, 2).tolist())) for _ in range(20)]
    times = sorted({0, 5, 1000, -7_000, year, *rng.integers(-10_000, year, 300).tolist()})
    samples = spark.createDataFrame([("n", t) for t in times], "node string, ms bigint")
    df = spark.createDataFrame([(f"i{i}", *s) for i, s in enumerate(spans)], CLEARS)
    for open_start in (False, True):
        got = evaluate.interval_join(samples, df, open_start, granule)
        want = {(f"i{i}", t) for i, (a, b) in enumerate(spans) for t in times
                if (a < t if open_start else a <= t) and t <= b}
        rows = [(r["name"], r["ms"]) for r in got.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want


def test_a_year_long_interval_is_some_tens_of_segments(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(7_000, 37_003)], "a bigint, b bigint")  # granules of a year
    found = df.select(F.inline(evaluate._dyadic("a", "b"))).collect()
    assert len(found) < 32
    covered = sorted(g for level, place in found
                     for g in range(place << level, (place + 1) << level))
    assert covered == list(range(7_000, 37_003))
