"""The registered queries and the pipeline on the smallest tables."""
import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from dayprints.llm import decontaminate, jaccard
from dayprints.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for name in ("pages", "documents", "embeddings"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    result = con.execute(ORACLES[key])
    names = [d[0] for d in result.description]
    want = sorted(result.fetchall(), key=repr)
    got = sorted((tuple(r) for r in QUERIES[key](spark, SF).select(*names).collect()), key=repr)
    assert got == want


def test_all_are_registered():
    keys = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(keys)
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES}


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.unionByName(spark.createDataFrame(
        [(10_000, None, "en", "s", 0), (10_001, "123 !", "en", "s", 5)], docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    spoken = stages["language_id"](spark, rows, SF)
    kept = {r["doc_id"] for r in spoken.collect()}
    assert spoken.columns == docs.columns and not {10_000, 10_001} & kept
    assert kept >= {r["doc_id"] for r in docs.where("length(text) > 100").collect()}
    single = stages["near_copies"](spark, docs, SF)
    groups = jaccard.grouped(docs).collect()
    assert {r["doc_id"] for r in single.collect()} == {r["component_id"] for r in groups}
    clean = stages["decontamination"](spark, docs, SF)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    held = {r["doc_id"] for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert held and {r["doc_id"] for r in clean.collect()} == {
        r["doc_id"] for r in docs.collect()} - held
    calm = stages["toxicity"](spark, docs, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    marked = docs.join(labels.where("toxic = 1"), "doc_id").count()
    assert calm.columns == docs.columns and 0 < docs.count() - calm.count() <= 2 * marked + 2
    result = corpus_pipeline.run(spark, SF)
    assert 0 < result.count() < docs.count()


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_send_few_rows_at_once(spark, name):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5)
        dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
        size = F.arrow_udf(lambda x: pa.array([len(x)] * len(x), pa.int64()), "bigint")
        rows = spark.range(5000, numPartitions=1).select(size("id").alias("n"))
        assert rows.agg(F.max("n")).first()[0] <= 2048
    finally:
        spark.conf.set(key, before)
