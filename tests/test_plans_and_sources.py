"""Whole jobs on stored tables: a rerun adds nothing, marks move on."""

import json

import pytest
from pyspark.sql import functions as F

from dayprints import schemas
from dayprints.operators import microclusters as mc
from dayprints.plans import mobility, places, social
from dayprints.session import scratch_path
from dayprints.sources import datapoints, events, extract, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark):
    return {"path": scratch_path(spark, "store")}


def _counts(spark, store, names):
    return {n: tables.read_table(spark, n, store).count() for n in names}


def test_mobility_job_is_incremental(spark, store):
    points = events.datapoints(spark, SF)
    names = ["mobility_summary", "distance", "speed", "last_modification"]
    seen = mobility.run(spark, points, store, "2024-01-20")
    first = _counts(spark, store, names)
    assert seen["user_days"] > 0 and seen["rows"] == first["distance"]
    mobility.run(spark, points, store, "2024-01-20")
    assert _counts(spark, store, names) == first
    mobility.run(spark, points, store, "2024-01-31")
    header = tables.read_table(spark, "mobility_summary", store)
    assert header.count() == header.distinct().count() > first["mobility_summary"]
    distance = tables.read_table(spark, "distance", store)
    key = ["service", "user", "day", "source", "type"]
    assert distance.count() == distance.select(*key).distinct().count()
    # two runs end where one would
    once = {"path": scratch_path(spark, "once")}
    mobility.run(spark, points, once, "2024-01-31")
    assert _counts(spark, once, names) == _counts(spark, store, names)
    marks = tables.read_table(spark, "last_modification", store)
    assert marks.agg(F.max("date")).first()[0].day == 28


def test_social_job(spark, store):
    points = events.datapoints(spark, SF)
    names = ["social_summary", "call_register", "appusage", "last_modification"]
    social.run(spark, points, store, "2024-01-20")
    first = _counts(spark, store, names)
    social.run(spark, points, store, "2024-01-20")
    assert _counts(spark, store, names) == first


def test_clustering_job_starts_then_merges(spark, store):
    p = mc.Params(sample_skip=3)
    points = events.datapoints(spark, SF).withColumns(
        {"longitude": F.lit(0.5), "latitude": F.col("event_id") % 2 * 0.00001})
    places.run(spark, points, store, "2024-01-15", p)
    first = tables.read_table(spark, "clusters", store)
    assert set(first.columns) == {c.split()[0] for c in schemas.CLUSTERS.split(",")}
    n = first.agg(F.sum("N")).first()[0]
    places.run(spark, points, store, "2024-01-15", p)
    assert tables.read_table(spark, "clusters", store).agg(F.sum("N")).first()[0] == n
    places.run(spark, points, store, "2024-01-31", p)
    assert tables.read_table(spark, "clusters", store).agg(F.sum("N")).first()[0] > n


class Died(Exception):
    pass


def _run_dying(monkeypatch, module, run, at):
    """Run a job that stops before its ``at``-th write; False if it has fewer writes."""
    calls = []
    for name in ("write_table", "replace_table"):
        def counted(*args, real=getattr(tables, name), **options):
            calls.append(name)
            if len(calls) == at:
                raise Died
            return real(*args, **options)
        monkeypatch.setattr(module, name, counted, raising=False)
    try:
        run()
        return len(calls) >= at
    except Died:
        return True
    finally:
        monkeypatch.undo()


def _content(spark, store, names):
    def plain(v):
        return round(v, 9) if isinstance(v, float) else str(v)
    out = {}
    for n in names:
        df = tables.read_table(spark, n, store)
        out[n] = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    return out


JOBS = {
    "mobility": (mobility, {}, ["mobility_summary", "distance", "speed", "last_modification"]),
    "social": (social, {}, ["social_summary", "call_register", "appusage", "last_modification"]),
    "places": (places, {"p": mc.Params(sample_skip=3)},
               ["cluster_state", "clusters", "last_modification"]),
}


@pytest.mark.parametrize("job", JOBS)
def test_job_that_dies_before_any_write_is_repeated(spark, store, monkeypatch, job):
    module, options, names = JOBS[job]
    # users have samples in two services, and one user is null
    points = events.datapoints(spark, SF).withColumns({
        "service": F.expr("concat('s', event_id % 2)"),
        "user": F.expr("nullif(user, '0')")})
    if job == "places":
        points = points.withColumns({
            "longitude": F.lit(0.5), "latitude": F.col("event_id") % 2 * 0.00001,
            "speed": F.lit(0.0), "accuracy": F.lit(0.0)})
    once = {"path": scratch_path(spark, "once")}
    for as_of in ("2024-01-15", "2024-01-31"):
        module.run(spark, points, once, as_of, **options)
    module.run(spark, points, store, "2024-01-15", **options)
    for at in range(1, len(names) + 1):
        assert _run_dying(monkeypatch, module,
                          lambda: module.run(spark, points, store, "2024-01-31", **options), at)
    module.run(spark, points, store, "2024-01-31", **options)
    want = _content(spark, once, names)
    assert all(want.values())
    assert _content(spark, store, names) == want
    if job == "places":
        state = tables.read_table(spark, "cluster_state", store)
        owners = state.select("service", "user").distinct()
        assert owners.count() > state.select("user").distinct().count()


def test_replaced_table_keeps_the_last_complete_version(spark, store):
    rows = lambda n: spark.range(n)
    assert tables.read_table_or_empty(spark, "t", store, "id bigint").count() == 0
    rows(1).write.parquet(f"{store['path']}/t/version=1/_temporary")  # a write that died
    assert tables.read_table_or_empty(spark, "t", store, "id bigint").count() == 0
    for n in (2, 3, 4):
        tables.replace_table(rows(n), "t", store)
        assert tables.read_table(spark, "t", store).count() == n
    tables.replace_table(tables.read_table(spark, "t", store).where("id > 0"), "t", store)
    assert tables.read_table(spark, "t", store).count() == 3
    assert tables._numbered(spark, f"{store['path']}/t", "version")[0] == [3, 4]


def test_readers_on_files(spark, tmp_path):
    (tmp_path / "wearable.json").write_text(json.dumps({"activities-distance": [
        {"dateTime": "2018-03-10", "value": "1.5"}, {"dateTime": "2018-03-11", "value": "0"}]}, indent=1))
    rows = datapoints.read_wearable(spark, str(tmp_path / "wearable.json")).collect()
    assert [r["km"] for r in rows] == [1.5, 0.0]
    (tmp_path / "flat.json").write_text("\n".join(json.dumps(r) for r in [
        {"longitude": "1.5", "latitude": "2", "accuracy": "10", "speed": "0.1"},
        {"longitude": "-1", "latitude": "2", "accuracy": "10", "speed": "0.1"},
        {"longitude": None, "latitude": "2"},
        {"longitude": "3", "latitude": "4", "accuracy": "300", "speed": "0.1"}]))
    flat = str(tmp_path / "flat.json")
    assert datapoints.read_points(spark, flat).count() == 2
    assert datapoints.read_points(spark, flat, strict=True).count() == 1
    (tmp_path / "lines.txt").write_text("b\nc\n\na\n")
    assert [r["value"] for r in datapoints.read_text_sorted(spark, str(tmp_path / "lines.txt")).collect()
            ] == ["", "a", "b", "c"]


def test_extract_users(spark):
    rows = spark.createDataFrame([("a", "wifi"), ("b", "wifi"), ("a", "call")],
                                 "user string, schema_name string")
    assert extract.extract(rows, "wifis", [""]).count() == 2
    assert extract.extract(rows, "wifis", ["a"]).count() == 1
    users = spark.createDataFrame([("b",)], "user string")
    assert extract.extract(rows, "wifis", users).count() == 1
    with pytest.raises(KeyError):
        extract.extract(rows, "unknown")


def test_jdbc_credentials_come_from_options_or_environment(monkeypatch):
    monkeypatch.setenv("DAYPRINTS_DB_USER", "reader")
    assert tables._jdbc_options({"url": "u"})["user"] == "reader"
    assert tables._jdbc_options({"url": "u", "user": "me"})["user"] == "me"


def test_a_job_deletes_its_own_steps(spark, store):
    from pathlib import Path

    from dayprints import session
    kept = session.cut_lineage(spark.range(3).toDF("id"))
    folder = Path(session.shared_dir(spark).removeprefix("file:")) / "dayprints"
    before = set(folder.iterdir())
    mobility.run(spark, events.datapoints(spark, SF), store, "2024-01-20")
    assert set(folder.iterdir()) - before <= {Path(store["path"])} and kept.count() == 3


def test_an_append_is_whole_or_absent(spark, store):
    def broken(batches):
        from pyspark import TaskContext
        for batch in batches:
            yield batch
        if TaskContext.get().partitionId() == 3:
            raise RuntimeError("this task dies")

    rows = lambda n, day: spark.range(n).select(
        "id", F.lit(day).cast("date").alias("day"))
    assert tables.read_table_or_empty(spark, "t", store, "id bigint, day date").count() == 0
    bad = rows(40, "2024-01-01").repartition(4).mapInArrow(broken, "id bigint, day date")
    with pytest.raises(Exception, match="dies"):
        tables.write_table(bad, "t", store)
    assert tables.read_table_or_empty(spark, "t", store, "id bigint, day date").count() == 0
    tables.write_table(rows(5, "2024-01-01"), "t", store, partition_by="day")
    with pytest.raises(Exception, match="dies"):
        tables.write_table(bad, "t", store, partition_by="day")
    # a driver that dies while files are moved leaves some of them, without the mark
    path = f"{store['path']}/t"
    rows(7, "2024-01-02").write.partitionBy("day").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/append=1")
    read = tables.read_table(spark, "t", store)
    assert read.count() == 5 and read.columns == ["id", "day"]
    tables.write_table(rows(2, "2024-01-03"), "t", store, partition_by="day")
    read = tables.read_table(spark, "t", store)
    assert {str(r["day"]): r["count"] for r in read.groupBy("day").count().collect()} == {
        "2024-01-01": 5, "2024-01-03": 2}
    tables.write_table(rows(1, "2024-01-04"), "t", store, "overwrite")
    assert tables.read_table(spark, "t", store).count() == 1


def test_folders_written_otherwise_are_read_and_appended(spark, store):
    spark.range(3).toDF("id").write.parquet(f"{store['path']}/plain")
    tables.write_table(spark.range(2).toDF("id"), "plain", store)
    assert tables.read_table(spark, "plain", store).count() == 5
