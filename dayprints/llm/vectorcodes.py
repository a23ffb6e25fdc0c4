"""Vector codes: each part of a vector becomes the index of its codebook's nearest entry.

Parts are vectors of integers. The distinct parts, sorted, are the leaves of a trie with one
level for each dimension. A node holds the distances of its prefix to all entries, summed over
the dimensions so far; its children add one dimension to it, so a prefix that many parts share
is measured once. Leaves take the smallest sum, and add the part times the number of vectors
that hold it to the entry's sums. All of it is exact integer arithmetic.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayprints.llm.texts import lean
from dayprints.session import cut_lineage

LEAVES = 1024  # leaves whose nodes are measured together, a level at a time
NEW = ("code", "error", "label_error", "codebooks_sha256")


def coded(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4,
          scale: int = 1024, vec_id: str = "vec_id", vector: str = "embedding",
          label: str = "label") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) for every usable vector.

    A component x becomes floor(scale * x). Vectors are cut into ``parts`` equal consecutive
    parts (the last ones shorter, where the dimension is no multiple); each part position has
    its own codebook, started from the ``entries`` smallest ids (null ids last; rows of the same
    id by their components), improved in ``rounds`` rounds. Entries that no part uses stay. Ties
    go to the lower index. ``error`` is the squared distance of the integer vector to its code,
    ``label_error`` its sum over all rows of the label, nulls together; the code has two hex
    digits for each part, more where ``entries`` passes 256.

    Vectors that are null or hold null or non-finite components give no row. An empty table
    gives none. Vectors of another than the commonest dimension (ties: the shorter one), and
    those with a component so large that the error could pass 64 bits (about 2**17 at 64
    dimensions and a scale of 1024), have no code: their code and error are null and they shape
    no codebook. Vectors of no components have an empty code and error 0. Repeated rows count as
    often as they stand there; other columns are not read.

    Codebooks, bounded by ``entries`` times the dimension, go through the driver; every round
    reads the distinct parts, which lie sorted in the shared folder with their weights.
    """
    spark = vectors.sparkSession
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col(vector).isNotNull() & usable).select(
        F.col(vec_id).alias("id"), F.col(label).alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
    rows = cut_lineage(rows)
    common = (rows.groupBy(F.size("v").alias("d")).count()
              .orderBy(F.col("count").desc(), "d").first())
    dim = common["d"] if common else 0
    most = int((2**62 / max(1, dim)) ** 0.5 / 2)
    fits = (F.size("v") == dim) & F.forall("v", lambda x: x.between(-most, most))
    cuts = _cuts(dim, parts)
    books = _first_entries(rows.where(fits), cuts, entries)
    leaves = _distinct_parts(rows.where(fits), cuts)
    for _ in range(rounds):
        books = _improved(leaves, books)

    schema = rows.select("id", "label", F.lit("").alias("code"),
                         F.lit(0).cast("long").alias("error")).schema
    for field in schema:
        field.nullable = True
    done = cut_lineage(rows.select("id", "label", F.when(fits, F.col("v")).alias("v"))
                       .mapInArrow(_codes(books, cuts, entries), schema))
    sums = cut_lineage(done.groupBy(F.col("label").alias("of"))
                       .agg(F.sum("error").alias("label_error")))
    return done.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias(vec_id), F.col("label").alias(label), "code", "error",
        F.coalesce("label_error", F.lit(0).cast("long")).alias("label_error"),
        F.lit(digest(books)).alias("codebooks_sha256"))


def digest(books: list[np.ndarray]) -> str:
    """Of all entries' integers by part, entry and position within the part."""
    numbers = (str(x) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def nearest_entries(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry for each row of ``points``.

    The rows must be distinct and in lexicographic order. The trie is walked depth-first: a node
    with many leaves is descended into on its own; runs of smaller children are measured
    together, each distinct prefix once, a level at a time.
    """
    n, dim = points.shape
    index, distance = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if not len(book) or not n:
        return index, distance
    widest = max(int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.int32 if dim * (2 * widest) ** 2 < 2**31 else np.int64
    points, book = points.astype(kind), book.astype(kind)
    stack = [(0, n, 0, np.zeros(len(book), dtype=kind))]  # leaves from, to; depth; node's sums
    while stack:
        low, high, depth, sums = stack.pop()
        if high - low <= LEAVES or depth == dim:
            index[low:high], distance[low:high] = _measured(points[low:high], book, depth, sums)
            continue
        column = points[low:high, depth]
        borders = low + np.r_[0, np.flatnonzero(column[1:] != column[:-1]) + 1, high - low]
        at, last = 0, len(borders) - 1
        while at < last:
            to = int(np.searchsorted(borders, borders[at] + LEAVES, "right")) - 1
            if to > at:  # several children, or one, of few leaves together
                stack.append((int(borders[at]), int(borders[to]), depth, sums))
            else:
                to = at + 1
                step = points[borders[at], depth] - book[:, depth]
                stack.append((int(borders[at]), int(borders[to]), depth + 1, sums + step * step))
            at = to
    return index, distance


def _measured(points, book, depth, sums) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries of a few neighbouring leaves below one node."""
    nodes = sums[None, :]
    node_of = np.zeros(len(points), dtype=np.int64)
    differs = np.zeros(len(points), dtype=bool)
    differs[0] = True
    for d in range(depth, points.shape[1]):
        differs[1:] |= points[1:, d] != points[:-1, d]
        first = np.flatnonzero(differs)
        step = points[first, d][:, None] - book[None, :, d]
        step *= step
        step += nodes if len(first) == len(nodes) else nodes[node_of[first]]
        nodes, node_of = step, np.cumsum(differs) - 1
    best = nodes.argmin(axis=1)[node_of]
    return best, nodes[node_of, best]


def sorted_distinct(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, and for each row the number of its own."""
    if not len(points) or not points.shape[1]:
        return points[:1], np.zeros(len(points), dtype=np.int64)
    order = np.lexsort(points.T[::-1])
    ranked = points[order]
    new = np.r_[True, (ranked[1:] != ranked[:-1]).any(axis=1)]
    own = np.empty(len(points), dtype=np.int64)
    own[order] = np.cumsum(new) - 1
    return ranked[new], own


def _cuts(dim: int, parts: int) -> list[tuple[int, int]]:
    width = -(-dim // parts)
    return [(min(dim, i * width), min(dim, (i + 1) * width)) for i in range(parts)]


def _first_entries(rows: DataFrame, cuts, entries: int) -> list[np.ndarray]:
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    return [np.array([row["v"][a:b] for row in first], dtype=np.int64).reshape(len(first), b - a)
            for a, b in cuts]


def _distinct_parts(rows: DataFrame, cuts) -> DataFrame:
    """(position, part, weight), sorted by position and part over ordered files."""
    each = F.array(*[F.slice("v", a + 1, b - a) for a, b in cuts])
    parts = (rows.select(F.posexplode(each).alias("position", "part"))
             .groupBy("position", "part").agg(F.count("*").alias("weight")))
    ranged = parts.repartitionByRange("position", "part")
    return cut_lineage(ranged.sortWithinPartitions("position", "part"))


def _improved(leaves: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Each entry as the floor of the mean of its parts; entries without parts stay."""
    width = max(book.shape[1] for book in books)
    if not width:
        return books
    sums = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    found = (leaves.mapInArrow(_weighted_sums(books),
                               "position int, entry int, n long, sums array<long>")
             .groupBy("position", "entry")
             .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), *sums).collect())
    books = [book.copy() for book in books]
    for row in found:
        book = books[row["position"]]
        for i in range(book.shape[1]):
            book[row["entry"], i] = int(row[f"s{i}"]) // int(row["n"])
    return books


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(len(column), width)


def _weighted_sums(books: list[np.ndarray]):
    """Per task and used entry, the number and the sum of the parts assigned to it."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(book), dtype=np.int64) for book in books]
        totals = [np.zeros(book.shape, dtype=np.int64) for book in books]
        for batch in lean(batches):
            positions = batch.column(0).to_numpy()
            for position in np.unique(positions).tolist():
                own = batch.filter(pa.array(positions == position))
                points = _matrix(own.column(1), books[position].shape[1])
                weight = own.column(2).to_numpy()
                points, number = sorted_distinct(points)  # a task may read several files
                weight = _by_number(weight, number, len(points))
                entry, _ = nearest_entries(points, books[position])
                np.add.at(counts[position], entry, weight)
                np.add.at(totals[position], entry, points * weight[:, None])
        used = [(p, e) for p, n in enumerate(counts) for e in np.flatnonzero(n).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()),
             pa.array([int(counts[p][e]) for p, e in used], pa.int64()),
             pa.array([totals[p][e].tolist() for p, e in used], pa.list_(pa.int64()))],
            ["position", "entry", "n", "sums"])
    return sums


def _by_number(weight: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(n, dtype=np.int64)
    np.add.at(total, number, weight)
    return total


def _codes(books: list[np.ndarray], cuts, entries: int):
    """Adds each row's code and error; rows without ``v`` get nulls."""
    digits = max(2, len(f"{max(0, entries - 1):x}"))
    names = np.array([f"{i:0{digits}x}" for i in range(max(1, entries))])

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            vectors = batch.column(2)
            there = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
            matrix = _matrix(vectors.take(pa.array(there)), cuts[-1][1])
            text = np.full(len(there), "", dtype=f"U{digits * len(cuts)}")
            error = np.zeros(len(there), dtype=np.int64)
            if matrix.shape[1]:
                for (a, b), book in zip(cuts, books, strict=True):
                    points, own = sorted_distinct(matrix[:, a:b])
                    entry, distance = nearest_entries(points, book)
                    text = np.char.add(text, names[entry[own]])
                    error += distance[own]
            code = np.full(batch.num_rows, None, dtype=object)
            code[there] = text
            value, missing = np.zeros(batch.num_rows, dtype=np.int64), np.ones(batch.num_rows, bool)
            value[there], missing[there] = error, False
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()),
                 pa.array(value, mask=missing)], ["id", "label", "code", "error"])
    return codes
