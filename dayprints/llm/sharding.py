"""Contiguous shards of nearly equal size, cut from global prefix sums.

Rows are sorted over ordered partitions. Each partition tells its total size; the prefix sums of
these few totals give every partition the size that stands before it, so that it can place its
own rows without seeing others. A row belongs to the shard whose stretch of the total holds the
row's midpoint. So shards are contiguous in the order, cuts lie at equal targets up to half a
row, and a shard differs from an equal share by at most the size of its largest border row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayprints.llm.texts import lean
from dayprints.session import shared_dir

NEW = ("size", "shard", "slot")
_SALT, _DIGEST, _ORDER, _SIZE = "_shard_salt", "_shard_digest", "_shard_order_{}", "_shard_size"


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of a text plus one, for what stands between two texts; 1 for a null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def sharded(df: DataFrame, shards: int, order: list[Column], size: Column | None = None) -> DataFrame:
    """The columns of ``df``, then ``size``, ``shard`` (from 0) and ``slot`` (gapless from 0).

    Rows are taken in the order of ``order``, nulls first; ties are ordered by a digest of the
    whole row, so only equal rows can change places. ``size`` is by default ``text_size()``; a
    null counts as 0. Columns of ``df`` with one of the three names are replaced (``order`` and
    ``size`` still see them). An empty table gives no rows; with fewer rows than shards, or with
    rows larger than a share, some shards stay empty. Sums are exact up to 2**58 bytes over the
    number of shards.

    One sort by range, kept in the shared folder so that its partitions stay as they are when an
    executor is lost, then two passes over sizes. What the driver gets is two numbers for each
    partition and one for each shard. Many rows with equal keys spread over tasks by a salt.
    """
    spark = df.sparkSession
    shared_dir(spark)
    keep = [c for c in df.columns if c not in NEW]
    simple = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
    keys = [_ORDER.format(i) for i in range(len(order))]
    rows = df.withColumns({
        **dict(zip(keys, order, strict=True)),
        _SIZE: F.coalesce(text_size() if size is None else size, F.lit(0)).cast("long"),
        _DIGEST: F.xxhash64(*simple), _SALT: F.spark_partition_id(),
    }).select(*[F.col(f"`{c}`") for c in keep], *keys, _SIZE, _DIGEST, _SALT)
    by = [F.col(k).asc_nulls_first() for k in (*keys, _SIZE, _DIGEST, _SALT)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop(*keys, _DIGEST, _SALT)
    ranged = ranged.checkpoint()

    totals = ranged.select(_SIZE).mapInArrow(_totals, "part int, bytes long, n long").collect()
    before, at, first_row = {}, 0, 0
    for row in sorted(totals, key=lambda row: row["part"]):
        before[row["part"]] = (at, first_row)
        at, first_row = at + row["bytes"], first_row + row["n"]
    place = _place(before, at, shards)
    firsts = (ranged.select(_SIZE).mapInArrow(_first_rows(place), "shard int, row long")
              .groupBy("shard").agg(F.min("row").alias("row")).collect())
    starts = np.zeros(shards, dtype=np.int64)
    for row in firsts:
        starts[row["shard"]] = row["row"]

    schema = rows.select(*[F.col(f"`{c}`") for c in keep], F.col(_SIZE).alias("size"),
                         F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).schema
    return ranged.mapInArrow(_slots(place, starts), schema)


def write(df: DataFrame, path: str, shards: int, order: list[Column],
          size: Column | None = None) -> None:
    """Shards as folders ``shard=N`` of Parquet files; files by name, then rows, are in order."""
    placed = sharded(df, shards, order, size)
    placed.write.partitionBy("shard").parquet(path)


def _sizes(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(_SIZE)).to_numpy(zero_copy_only=False)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size, n = 0, 0
    for batch in batches:
        size, n = size + int(_sizes(batch).sum()), n + batch.num_rows
    if n:
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([size], pa.int64()), pa.array([n], pa.int64())],
            ["part", "bytes", "n"])


def _place(before: dict[int, tuple[int, int]], total: int, shards: int):
    """A function that gives, batch for batch, each row's shard and its number in the order."""
    def rows(batches):
        at, row = before.get(TaskContext.get().partitionId(), (0, 0))
        for batch in batches:
            sizes = _sizes(batch)
            ends = at + np.cumsum(sizes, dtype=np.int64)
            middle = 2 * ends - sizes  # twice the midpoint
            shard = np.minimum(middle * shards // max(1, 2 * total), shards - 1)
            yield batch, shard.astype(np.int32), row + np.arange(batch.num_rows, dtype=np.int64)
            at, row = (int(ends[-1]) if len(ends) else at), row + batch.num_rows
    return rows


def _first_rows(place):
    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for _, shard, row in place(batches):
            values, index = np.unique(shard, return_index=True)
            for value, i in zip(values.tolist(), index.tolist(), strict=True):
                seen.setdefault(value, int(row[i]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())],
            ["shard", "row"])
    return firsts


def _slots(place, starts: np.ndarray):
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, shard, row in place(lean(batches)):
            names = batch.schema.names
            columns = [c for c, name in zip(batch.columns, names, strict=True) if name != _SIZE]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column(names.index(_SIZE)), pa.array(shard),
                 pa.array(row - starts[shard])],
                [name for name in names if name != _SIZE] + list(NEW))
    return slots
