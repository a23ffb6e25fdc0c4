"""Two-level windows equal plain ones, also for one hot key and shuffled input."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dayprints.operators import ordered


@pytest.fixture(scope="module")
def rows(spark):
    # nine tenths of the rows share a key; gaps of hours and equal times occur
    return (spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 70)).alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
            secs=F.pmod(F.xxhash64("id"), F.lit(400000)).cast("decimal(18,6)"))).alias("ts"),
        (F.pmod(F.hash("id"), F.lit(7)) - 2).cast("bigint").alias("v"))
        .repartition(7).cache())


@pytest.mark.parametrize("descending", [False, True])
def test_running_and_previous(rows, descending):
    order = ["ts", "event_id"]
    w = Window.partitionBy("k").orderBy(*[F.col(c).desc() if descending else F.col(c) for c in order])
    plain = rows.select("event_id", F.row_number().over(w).alias("rn"),
                        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
                        F.lag("v").over(w).alias("p")).collect()
    ours = ordered.running(rows, ["k"], order, {
        "rn": ("sum", F.lit(1)), "s": ("sum", F.col("v")), "m": ("max", F.col("v"))},
        descending=descending)
    ours = ordered.previous(ours, ["k"], order, {"p": F.col("v")}, descending=descending)
    got = ours.select("event_id", "rn", "s", "m", "p").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain))


def test_hot_key_is_split(rows):
    plan = ordered.row_numbers(rows, ["k"], ["ts", "event_id"])._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Window [sum" in plan and "__range" in plan and "Join" not in plan


def test_empty(spark, rows):
    none = rows.where("event_id < 0")
    assert ordered.row_numbers(none, ["k"], ["ts", "event_id"]).count() == 0


def test_null_keys_are_one_group(table):
    from pyspark.sql import functions as F

    from dayprints.operators import ordered
    rows = [(1, None, "2024-01-01 00:10:00"), (2, None, "2024-01-01 01:10:00"),
            (3, "a", "2024-01-01 00:20:00"), (4, "a", "2024-01-01 02:10:00")]
    df = table(rows, "event_id long, user string, ts timestamp_ntz")
    numbered = ordered.row_numbers(df, ["user"], ["ts", "event_id"])
    assert {r["event_id"]: r["rn"] for r in numbered.collect()} == {1: 1, 2: 2, 3: 1, 4: 2}
    before = ordered.previous(df, ["user"], ["ts", "event_id"], {"before": F.col("event_id")})
    assert {r["event_id"]: r["before"] for r in before.collect()} == {1: None, 2: 1, 3: None, 4: 3}


def test_one_second_with_half_of_the_rows_spreads(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("event_id"), F.lit("u").alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit("2024-01-01 00:00:07")).otherwise(
            F.concat(F.lit("2024-01-0"), F.col("id") % 9 + 1)).cast("timestamp_ntz").alias("ts"))
    placed = ordered.ranged(rows, ["k"], ["ts", "event_id"], ranges=27).orderBy("ts", "event_id")
    ranges = [r["__range"] for r in placed.collect()]
    assert ranges == sorted(ranges)
    assert max(ranges.count(r) for r in set(ranges)) < 2_000 and len(set(ranges)) == 27


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_neighbours_on_both_sides(spark, rows, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = ordered.neighbours(
            rows, ["k"], ["ts", "event_id"],
            {"p2": (-2, F.col("v")), "p1": (-1, F.col("event_id")), "n1": (1, F.col("v"))},
            {"head": ("first", F.col("p1")), "tail": ("last", F.col("event_id"))})
        found = {r["event_id"]: r for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    by_key = {}
    for r in sorted(rows.collect(), key=lambda r: (r["k"], r["ts"], r["event_id"])):
        by_key.setdefault(r["k"], []).append(r)
    for track in by_key.values():
        at = lambda i, c: track[i][c] if 0 <= i < len(track) else None  # noqa: B023, E731
        for i, r in enumerate(track):
            one = found.pop(r["event_id"])
            assert (one["p2"], one["p1"], one["n1"]) == (
                at(i - 2, "v"), at(i - 1, "event_id"), at(i + 1, "v"))
            if min(i, len(track) - 1 - i) < 2:  # the ends of a key know its ends
                assert one["tail"] == track[-1]["event_id"]
                assert one["head"] == (track[0]["event_id"] if len(track) > 1 else None)
    assert not found


def test_haar_of_steps_in_one_pass(spark, rows):
    from dayprints.operators import trajectory
    track = rows.select("k", "event_id", "ts", F.col("v").cast("double").alias("longitude"),
                        (F.col("v") * F.col("v")).cast("double").alias("latitude"))
    once = trajectory.haar_detail(track, ["k"], trajectory.step, trajectory.POSITION, reach=1)
    twice = trajectory.haar_detail(trajectory.step_distance(track, ["k"]), ["k"], "step")
    both = [sorted((r["event_id"], round(r["detail"], 9), round(r["smooth"], 9))
                   for r in df.collect()) for df in (once, twice)]
    assert both[0] == both[1] and len(both[0]) > 2_000
