"""A training corpus in five stages; each reads what its predecessor wrote.

Language ID, toxicity and decontamination drop documents, the n-gram join keeps one document of
each group of near copies, and the last stage encodes what remains. All but the last return the
columns of ``documents``.

Null, empty and letterless texts have no language, so they go in the first stage. Rows that
repeat an id are judged one by one, but near copies keep every row of the id that stands for its
group; rows without an id are kept there only if their whole group has none. Texts are read whole.
Empty tables give empty results; other columns of ``documents`` are carried along. Every stage
lets few rows at once go to a Python worker, which the session keeps (``texts.small_batches``).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayprints.llm import decontaminate, jaccard, langid, tokens, toxicity
from dayprints.llm.queries import ENCODING
from dayprints.llm.texts import free_name, small_batches, table
from dayprints.session import cut_lineage

TOXIC = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is accepted as one of the corpus's languages."""
    small_batches(spark)
    out = free_name(docs, "language")
    rows = langid.identified(docs, langid.train(docs), out=out)
    return rows.where(F.col(f"{out}.accepted")).drop(out)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely of grade 0 than of a higher one."""
    small_batches(spark)
    model = toxicity.from_labels(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.severity(F.col("text"), model)["p_toxic"] < TOXIC)


def copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    small_batches(spark)
    return jaccard.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of what remains."""
    small_batches(spark)
    vocabulary = tokens.load(spark, public_tokenizers.path(ENCODING))
    coded = tokens.round_trip(F.col("text"), vocabulary, public_tokenizers.PATTERN, with_ids=True)
    return docs.select("doc_id", coded.alias("c")).select(
        "doc_id", "c.ids", "c.n_tokens", "c.ids_sha256", "c.decoded_sha256")


STAGES = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("near_copies", copies_stage),
    ("decontamination", benchmark_stage),
    ("encoding", encoding_stage),
]

ORACLE_SQL = None  # language models, regressions and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written before the next one."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
