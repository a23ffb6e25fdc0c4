"""Vector codes against plain loops over all entries."""

import math
import random

import numpy as np
import pytest

from dayprints.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string"


def plain(rows, parts, entries, rounds, scale=1024):
    """{vec_id: (code, error)} and the codebooks, by trying every entry."""
    ints = [(i, [math.floor(scale * x) for x in v]) for i, v, _ in rows]
    width = -(-len(ints[0][1]) // parts)
    cut = [(i, [v[p * width:(p + 1) * width] for p in range(parts)]) for i, v in ints]
    books = [[v[p] for _, v in sorted(cut)[:entries]] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k)
                   for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for _, v in cut:
                members.setdefault(nearest(book, v[p])[1], []).append(v[p])
            for k, xs in members.items():
                book[k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out = {}
    for i, v in cut:
        best = [nearest(b, x) for b, x in zip(books, v, strict=True)]
        out[i] = ("".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best))
    return out, books


@pytest.mark.parametrize("dim, entries, copies", [(8, 256, 1), (6, 5, 3), (2, 4, 1)])
def test_equals_plain_loops(spark, dim, entries, copies):
    rng = random.Random(dim)
    vectors = [[rng.choice([-0.01, 0.0, 0.25, rng.gauss(0, 1)]) for _ in range(dim)]
               for _ in range(80)] * copies
    rows = [(i, v, rng.choice([0, 1, None])) for i, v in enumerate(vectors)]
    expected, books = plain(rows, 4, entries, 4)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    got = {r.vec_id: r for r in vectorcodes.coded(df, entries=entries).collect()}
    assert {i: (r.code, r.error) for i, r in got.items()} == expected
    assert {r.codebooks_sha256 for r in got.values()} == \
        {vectorcodes.digest([np.array(b, dtype=np.int64) for b in books])}
    for label in (0, 1, None):
        own = [i for i, _, x in rows if x == label]
        assert {got[i].label_error for i in own} == {sum(expected[i][1] for i in own)}


@pytest.mark.parametrize("spread", [2, 40, 10**6])
def test_trie_equals_all_distances(spread):
    rng = np.random.default_rng(spread)
    points, own = vectorcodes.sorted_distinct(rng.integers(-spread, spread, (6000, 5)))
    book = rng.integers(-spread, spread, (30, 5))
    assert (own < len(points)).all()
    index, distance = vectorcodes.nearest_entries(points, book)
    full = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (index == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_edges(spark):
    good = [0.5, -0.25, 0.125, 3.0]
    rows = [(1, good, 1), (1, good, 1), (2, None, 1), (3, [0.5, None, 0.0, 1.0], 1),
            (4, [0.5, float("nan"), 0.0, 1.0], 1), (5, [float("inf"), 0.0, 0.0, 1.0], 1),
            (6, [0.5], None), (7, [1e300, 0.0, 0.0, 0.0], None), (None, [0.0] * 4, None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = sorted(((r.vec_id, r.label, r.code, r.error, r.label_error)
                  for r in vectorcodes.coded(df).collect()), key=str)
    assert got == sorted([(1, 1, "00000000", 0, 0), (1, 1, "00000000", 0, 0),
                          (6, None, None, None, 0), (7, None, None, None, 0),
                          (None, None, "02020202", 0, 0)], key=str)
    assert vectorcodes.coded(df.limit(0)).collect() == []
    assert vectorcodes.coded(df.where("vec_id = 2")).collect() == []
    bare = spark.createDataFrame([(1, [], 1, "x", "y")], SCHEMA)
    assert [(r.code, r.error) for r in vectorcodes.coded(bare).collect()] == [("", 0)]
