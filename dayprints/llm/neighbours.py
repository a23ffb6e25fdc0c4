"""Approximate nearest neighbours: inverted lists and an adaptive scan over dimensions.

Centres of lists are fitted on a bounded sample; every vector is then put into the list of its
nearest centre. Lists are stored as blocks of bounded size, whatever a list's share of the rows:
original vectors, and vectors turned by a random rotation in blocks of columns. How many lists a
query probes is set on the sample, so that its own neighbours there are found with the wanted
recall, and never fewer than hold ``k`` candidates.

A probed block is scanned column block by column block. After d of D dimensions a candidate is
given up if its partial distance says, at the level ``EPSILON``, that its distance is beyond the
query's k-th so far: partial > limit * d / D * (1 + EPSILON / sqrt(d))^2. What remains is
measured exactly, in double precision on the original vectors.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do vectors
whose length is not the most common one. Rows that repeat a vec_id count once, with their
smallest distance. Ties go to the smaller vec_id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayprints.llm.texts import bounded_sample
from dayprints.session import cut_lineage

K = 10
EPSILON = 2.1
COLUMNS = 16
SAMPLE = 20_000
MAX_LISTS = 4096
BLOCK_ROWS = 2048
PACK_QUERIES = 256
RECALL = 0.97
ROUNDS = 8


def usable(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part; floats stay floats, all else is double."""
    v = F.col("vector")
    kept = df.schema[embedding].dataType.simpleString() == "array<float>"
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast(
        "array<float>" if kept else "array<double>").alias("vector"))
    rows = rows.where(v.isNotNull() & F.col("vec_id").isNotNull()
                      & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                                 & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0))
    size = rows.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size(v) == (size["size"] if size else 0))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances between the rows of a and b."""
    out = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.maximum(out, 0)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.float32)


def fit(vectors: DataFrame) -> dict:
    """Centres, rotation and probe depth, from at most ``SAMPLE`` vectors."""
    rows = vectors.count()
    sample = bounded_sample(vectors, "vec_id", SAMPLE).orderBy("vec_id", "vector").toArrow()
    seen = np.unique(matrix(sample["vector"].combine_chunks()), axis=0).astype(np.float64)
    rng = np.random.default_rng(17)
    if not len(seen):
        return {"centres": np.empty((0, 0)), "rotation": np.empty((0, 0)), "probes": 0}
    count = max(1, min(MAX_LISTS, len(seen) // 8, int(math.sqrt(rows))))
    centres = seen[rng.permutation(len(seen))[:count]].copy()
    for _ in range(ROUNDS):
        nearest = _nearest(seen, centres)
        order = np.argsort(nearest, kind="stable")
        found, first = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(seen[order], first, axis=0)
        sizes = np.diff([*first, len(seen)])
        centres[found] = sums / sizes[:, None]
    rotation, _ = np.linalg.qr(rng.standard_normal((seen.shape[1], seen.shape[1])))
    queries = seen[rng.permutation(len(seen))[:256]]
    near = squared(queries, seen).argsort(axis=1)[:, 1:K + 1]
    lists = _nearest(seen, centres)
    order = squared(queries, centres).argsort(axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(count), order.shape), axis=1)
    depth = np.sort(np.take_along_axis(rank, lists[near], axis=1).ravel())
    at = max(0, math.ceil(RECALL * len(depth)) - 1)
    probes = int(depth[at]) + 1 if len(depth) else count
    return {"centres": centres, "rotation": rotation, "probes": min(count, probes)}


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = [squared(rows[i:i + 4096], centres).argmin(axis=1) for i in range(0, len(rows), 4096)]
    return np.concatenate(out) if out else np.empty(0, np.int64)


def assign(vectors: DataFrame, model: dict) -> DataFrame:
    """(vec_id, vector, list) of every vector, written out."""
    shared = vectors.sparkSession.sparkContext.broadcast(model["centres"])

    def put(batches):
        for batch in batches:
            if batch.num_rows:
                lists = _nearest(matrix(batch.column(1)).astype(np.float64), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(lists.astype(np.int32))],
                    ["vec_id", "vector", "list"])

    kind = vectors.schema["vector"].dataType.simpleString()
    return cut_lineage(vectors.mapInArrow(put, f"vec_id bigint, vector {kind}, list int"))


def build(assigned: DataFrame, sizes: dict[int, int], model: dict) -> DataFrame:
    """(list, part, ids, plain, turned): blocks of about ``BLOCK_ROWS`` vectors, original and
    rotated with each block of columns together. A list has as many blocks as it needs."""
    spark = assigned.sparkSession
    rotation = spark.sparkContext.broadcast(model["rotation"])

    def pack(table: pa.Table) -> pa.Table:
        plain = matrix(table["vector"].combine_chunks())
        turned = (plain.astype(np.float64) @ rotation.value).astype(np.float32)
        columns = b"".join(np.ascontiguousarray(turned[:, a:a + COLUMNS]).tobytes()
                           for a in range(0, turned.shape[1], COLUMNS))
        return pa.table({"list": pa.array([table["list"][0].as_py()], pa.int32()),
                         "part": pa.array([table["part"][0].as_py()], pa.int32()),
                         "ids": pa.array([table["vec_id"].to_pylist()], pa.list_(pa.int64())),
                         "plain": pa.array([plain.tobytes()], pa.binary()),
                         "turned": pa.array([columns], pa.binary())})

    blocks = _parts(sizes, BLOCK_ROWS)
    part = F.pmod(F.xxhash64("vec_id", "vector"), blocks(F.col("list"))).cast("int")
    return assigned.withColumn("part", part).groupBy("list", "part").applyInArrow(
        pack, "list int, part int, ids array<bigint>, plain binary, turned binary")


def _parts(sizes: dict[int, int], rows: int):
    """How many parts a list is cut into; the table of lists is bounded by ``MAX_LISTS``."""
    many = {k: math.ceil(n / rows) for k, n in sizes.items() if n > rows}
    if not many:
        return lambda c: F.lit(1)
    table = F.create_map(*[F.lit(x) for kv in many.items() for x in kv])
    return lambda c: F.coalesce(F.try_element_at(table, c), F.lit(1))


def probes(queries: DataFrame, sizes: dict[int, int], model: dict, k: int) -> DataFrame:
    """(query_id, query, list): each query with the lists it looks into."""
    held = np.array([sizes.get(i, 0) for i in range(len(model["centres"]))])
    shared = queries.sparkSession.sparkContext.broadcast(
        {"centres": model["centres"], "held": held})

    def choose(batches):
        centres, rows = shared.value["centres"], shared.value["held"]
        for batch in batches:
            if not batch.num_rows:
                continue
            order = squared(matrix(batch.column(1)).astype(np.float64), centres).argsort(axis=1)
            reach = rows[order].cumsum(axis=1)
            need = np.maximum(model["probes"], (reach <= 4 * k).sum(axis=1) + 1)
            lists = [o[:n].astype(np.int32) for o, n in zip(order, need, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.list_(pa.int32()))],
                ["query_id", "query", "lists"])

    kind = queries.schema["query"].dataType.simpleString()
    chosen = queries.mapInArrow(choose, f"query_id bigint, query {kind}, lists array<int>")
    return chosen.select("query_id", "query", F.explode("lists").alias("list"))


class Best:
    """The k nearest so far of each query."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def limit(self, query: int) -> float:
        known = self.held.get(query)
        return known[0][self.k - 1] if known and len(known[0]) == self.k else math.inf

    def add(self, query: int, distance: np.ndarray, ids: np.ndarray) -> None:
        if query in self.held:
            distance = np.concatenate((self.held[query][0], distance))
            ids = np.concatenate((self.held[query][1], ids))
        order = np.lexsort((ids, distance))
        distance, ids = distance[order], ids[order]
        _, first = np.unique(ids, return_index=True)  # a repeated id keeps its nearest row
        first = np.sort(first)[:self.k]
        self.held[query] = distance[first], ids[first]


def scan(query: int, vector: np.ndarray, turned: np.ndarray, ids: np.ndarray, plain: np.ndarray,
         columns: list[np.ndarray], best: Best) -> None:
    """One query against one block."""
    if best.limit(query) == math.inf:  # a first limit from a few candidates
        some = slice(0, 4 * best.k)
        _measure(query, vector, ids[some], plain[some], best)
    bound, size = best.limit(query), len(turned)
    alive = np.arange(len(ids))
    partial, done = np.zeros(len(ids), np.float32), 0
    for block in columns:
        width = block.shape[1]
        gap = block[alive] - turned[done:done + width]
        partial = partial + np.einsum("ij,ij->i", gap, gap)
        done += width
        test = bound * bound * done / size * (1 + EPSILON / math.sqrt(done)) ** 2
        keep = partial <= test
        alive, partial = alive[keep], partial[keep]
        if not len(alive):
            return
    _measure(query, vector, ids[alive], plain[alive], best)


def _measure(query, vector, ids, plain, best) -> None:
    other = ids != query
    gap = plain[other].astype(np.float64) - vector
    best.add(query, np.sqrt((gap * gap).sum(axis=1)), ids[other])


def nearest(df: DataFrame, is_query, k: int = K, vec_id: str = "vec_id",
            embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of the rows where ``is_query``.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    vectors = usable(df, vec_id, embedding)
    model = fit(vectors)
    result = "query_id bigint, vec_id bigint, score double"
    assigned = assign(vectors, model)
    sizes = {r["list"]: r["count"] for r in assigned.groupBy("list").count().collect()}
    queries = assigned.where(is_query).select(F.col("vec_id").alias("query_id"),
                                              F.col("vector").alias("query"))
    looks = cut_lineage(probes(queries, sizes, model, k))
    asked = {r["list"]: r["count"] for r in looks.groupBy("list").count().collect()}
    packs = (looks.withColumn("part", F.pmod(F.xxhash64("query_id"),
                                             _parts(asked, PACK_QUERIES)(F.col("list"))))
             .groupBy("list", "part").agg(F.collect_list("query_id").alias("queries"),
                                          F.flatten(F.collect_list("query")).alias("vectors"))
             .drop("part"))
    # a pack meets each block of its list on a key of their own, so a large list is many keys
    blocks = F.sequence(F.lit(0), _parts(sizes, BLOCK_ROWS)(F.col("list")) - 1)
    packs = packs.withColumn("part", F.explode(blocks))
    pairs = build(assigned, sizes, model).join(packs, ["list", "part"])
    exact = np.float32 if "float" in vectors.schema["vector"].simpleString() else np.float64
    rotation = df.sparkSession.sparkContext.broadcast(model["rotation"])

    def search(batches):
        best, size = Best(k), len(rotation.value)

        def rows():
            held = [(q, i, d) for q, (ds, vs) in best.held.items()
                    for d, i in zip(ds.tolist(), vs.tolist(), strict=True)]
            best.held.clear()
            return pa.RecordBatch.from_pylist(
                [{"query_id": q, "vec_id": i, "score": d} for q, i, d in held],
                schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()),
                                  ("score", pa.float64())]))

        for batch in batches:
            for row in range(batch.num_rows):
                value = {n: batch.column(n)[row] for n in ("ids", "plain", "turned", "queries",
                                                          "vectors")}
                ids = value["ids"].values.to_numpy()
                plain = np.frombuffer(value["plain"].as_buffer(), exact).reshape(-1, size)
                packed = np.frombuffer(value["turned"].as_buffer(), np.float32)
                columns, at = [], 0
                for a in range(0, size, COLUMNS):
                    width = min(COLUMNS, size - a)
                    columns.append(packed[at:at + len(ids) * width].reshape(-1, width))
                    at += len(ids) * width
                vectors = value["vectors"].values.to_numpy().reshape(-1, size).astype(np.float64)
                turned = (vectors @ rotation.value).astype(np.float32)
                for q, vector, around in zip(value["queries"].values.to_pylist(), vectors, turned,
                                             strict=True):
                    scan(q, vector, around, ids, plain, columns, best)
                if len(best.held) > 50_000:
                    yield rows()
        yield rows()

    found = pairs.mapInArrow(search, result)
    # two steps, so that no query is ranked in one task only
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
