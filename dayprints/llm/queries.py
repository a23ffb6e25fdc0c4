"""The operators over the given tables, one query each, and their SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayprints.llm import (decontaminate, divergence, jaccard, langid, licences, neighbours,
                           oracles, quality, sharding, tokens, toxicity, urls, vectorcodes)
from dayprints.llm.texts import fold, table
from dayprints.session import cut_lineage

ENCODING = "byte_bpe_multi_50k.tiktoken"
COUNTING = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
SHARDS = 8
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
             ("com", "/de/", "block")]


def encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.load(spark, public_tokenizers.path(ENCODING))
    coded = tokens.round_trip(F.col("text"), vocabulary, public_tokenizers.PATTERN)
    return (table(spark, sf_dir, "documents").select("doc_id", coded.alias("c"))
            .select("doc_id", "c.n_tokens", "c.ids_sha256", "c.decoded_sha256", "c.exact"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality.train(documents, table(spark, sf_dir, "labels"), keep=~held_out)
    return quality.scored(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.train(documents.where(~held_out))
    rows = langid.identified(documents, model, ~held_out)
    return rows.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "language.lang_pred", "language.score", "language.accepted")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.load(spark, public_tokenizers.path(COUNTING))
    n = tokens.token_counts(F.col("text"), vocabulary, public_tokenizers.PATTERN)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = table(spark, sf_dir, "documents").select("doc_id", size.alias("n_bytes"),
                                                    n.alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.grouped(table(spark, sf_dir, "documents"))


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.found(table(spark, sf_dir, "documents"))


def toxic_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.from_labels(documents, table(spark, sf_dir, "labels"))
    rows = toxicity.graded(documents, model)
    return rows.select("doc_id", "grade", "severity", "p_toxic",
                       (F.col("p_toxic") >= 0.5).alias("toxic"))


def byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = cut_lineage(table(spark, sf_dir, "documents").select(
        "doc_id", sharding.text_size("text").alias("size"), F.crc32(text).alias("text_crc32")))
    placed = sharding.sharded(rows, SHARDS, [F.col("doc_id"), F.col("text_crc32")], F.col("size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.coded(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_byte_bpe": encode,
    "op2_quality_rules": quality_scores,
    "op3_url_filter": url_verdicts,
    "op4_language_id": languages,
    "op5_token_counts": token_counts,
    "op6_decontaminate": contamination,
    "op7_nearest": nearest_vectors,
    "op8_jaccard_join": near_copies,
    "op9_licence_scan": licence_scan,
    "op10_toxicity": toxic_severity,
    "op11_byte_shards": byte_shards,
    "op12_vector_codes": vector_codes,
    "op13_source_divergence": source_divergence,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES = {
    "op3_url_filter": f"""
with a as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3)
                       else '' end as rest from pages),
b as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from a),
rules(rhost, rpath, rverdict) as (values
  {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
fits as (
  select page_id, host, path, rhost || rpath as rule, rverdict
  from (select distinct page_id, host, path from b), rules
  where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)),
best as (
  select page_id, host, path, arg_max(rule, length(rule)) as rule,
         arg_max(rverdict, length(rule)) as rverdict
  from fits group by all)
select b.page_id, b.host, b.path, best.rule, coalesce(best.rverdict, 'allow') as verdict
from b left join best on b.page_id is not distinct from best.page_id and b.host = best.host
  and b.path = best.path""",
    "op11_byte_shards": oracles.byte_shards(SHARDS),
    "op12_vector_codes": oracles.vector_codes(),
    "op13_source_divergence": oracles.source_divergence(),
}
