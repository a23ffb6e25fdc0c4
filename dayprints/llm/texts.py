"""Helpers shared by the text operators: tables, Arrow columns, seeded samples."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lean(parts: Iterator) -> Iterator:
    """The batches of a task; memory that earlier tasks and batches no longer use goes back.

    A worker process serves one stage after another. What its allocators keep of the last one
    would stand beside the executor's heap while the next one runs.
    """
    gc.collect()
    _give_back()
    for part in parts:
        yield part
        del part
        _give_back()


def in_slices(parts: Iterator, rows: int = 1024) -> Iterator:
    """The batches of a task in slices of some rows; what is made of one leaves before the next."""
    for part in lean(parts):
        for at in range(0, max(1, len(part)), rows):
            yield part.slice(at, rows)
            _give_back()


def small_batches(spark: SparkSession, rows: int = 2048) -> None:
    """From now on at most some rows go to a Python worker at once.

    A batch of whole texts stands in the worker and, outside its heap, in the executor, for each
    running task. The session keeps the setting, as jobs are planned only when they run.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def struct_array(columns: dict[str, pa.Array]) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % parts


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of ``key``; all rows if there are fewer.

    The choice depends on the keys alone, so it repeats. A row is kept if its whole 64-bit hash
    lies in the first 0.95 * bound / rows of all hashes, however small that share is; this stays
    below the bound at any size that matters, and ``limit`` makes it certain.
    """
    rows = df.count()
    if rows <= bound:
        return df
    below = (2**64 * 19 * bound) // (20 * rows) - 2**63
    return df.where(F.xxhash64(F.lit("sample"), F.col(key)) < below).limit(bound)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def is_letter() -> np.ndarray:
    """A flag for every code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int,
                    keep: Column | None = None, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, text, label, weight) of at most ``per_class`` labelled documents of each label.

    ``weight`` makes up for the classes' different shares. Null labels and ids are left out;
    ``keep`` is a condition on the column ``doc_id``. The ids, of a bounded number, are broadcast;
    of documents that share an id one stands for it, that with the smallest text.
    """
    rows = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).dropna()
    rows = rows.where(keep) if keep is not None else rows
    counts = rows.groupBy("label").count().orderBy("label").collect()
    parts = []
    for row in counts:
        part = bounded_sample(rows.where(F.col("label") == row["label"]), "doc_id", per_class)
        weight = max(1.0, row["count"] / (0.95 * per_class))
        parts.append(part.withColumn("weight", F.lit(weight)))
    chosen = rows.limit(0).withColumn("weight", F.lit(1.0))
    for part in parts:
        chosen = chosen.unionByName(part)
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label", "weight").agg(F.min("text").alias("text")).select(
        "doc_id", "text", "label", "weight")
