"""Shards against plain prefix sums."""

import random

import pytest
from pyspark.sql import functions as F

from dayprints.llm import sharding
from tests.llm.conftest import EDGE


def plain(rows, shards):
    """(row, shard, slot) of (key, size) rows in order, each by its midpoint."""
    rows = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), r[1]))
    total, at, slots, out = sum(size for _, size in rows), 0, {}, []
    for key, size in rows:
        shard = min(shards - 1, (2 * at + size) * shards // (2 * total)) if total else 0
        out.append((key, size, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
        at += size
    return out


def found(df):
    return [tuple(r) for r in df.select("doc_id", "size", "shard", "slot").collect()]


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_equals_prefix_sums(spark, shards):
    rng = random.Random(shards)
    rows = [(rng.randrange(10**6), rng.choice([1, 5, 40, 900])) for _ in range(3000)]
    rows = list({key: (key, size) for key, size in rows}.values())
    df = spark.createDataFrame(rows, "doc_id long, bytes long").repartition(7)
    got = found(sharding.sharded(df, shards, [F.col("doc_id")], F.col("bytes")))
    assert sorted(got) == sorted(plain(rows, shards))
    sums = {}
    for _, size, shard, _ in got:
        sums[shard] = sums.get(shard, 0) + size
    assert max(abs(s - sum(sums.values()) / shards) for s in sums.values()) <= 900


def test_one_key_with_half_of_the_rows_spreads(spark):
    rows = [(7, 3)] * 4000 + [(i, 3) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, bytes long").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sharding.sharded(df, 8, [F.col("doc_id")], F.col("bytes"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tasks = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(row["count"] for row in tasks) < 4000
    assert sorted(found(got)) == sorted(plain(rows, 8))


def test_edges(spark, docs):
    df = docs(EDGE).withColumns({"size": F.lit("mine"), "shard": F.lit(-1)})
    got = sharding.sharded(df, 3, [F.col("doc_id")]).collect()
    sizes = [1 if text is None else len(text.encode()) + 1 for _, text in EDGE]
    expected = plain([(i, s) for (i, _), s in zip(EDGE, sizes, strict=True)], 3)
    assert sorted((r.doc_id or -1, r.size, r.shard, r.slot) for r in got) == \
        sorted((i or -1, *rest) for i, *rest in expected)
    assert [r.n for r in got] == [1] * len(EDGE)
    empty = sharding.sharded(docs(EDGE).limit(0), 3, [F.col("doc_id")])
    assert empty.collect() == [] and empty.columns[-3:] == list(sharding.NEW)
    nothing = sharding.sharded(docs(EDGE), 3, [F.col("doc_id")], F.lit(None).cast("long"))
    assert {r.shard for r in nothing.collect()} == {0}


def test_written_shards_keep_the_order(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("doc_id"),
                                  F.repeat(F.lit("x"), F.col("id").cast("int")).alias("text"))
    sharding.write(df, str(tmp_path / "s"), 4, [F.col("doc_id")])
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 1000
    for shard in range(4):
        files = sorted((tmp_path / "s" / f"shard={shard}").glob("*.parquet"))
        ids = [r.doc_id for f in files for r in spark.read.parquet(str(f)).collect()]
        assert ids == sorted(ids) and ids
