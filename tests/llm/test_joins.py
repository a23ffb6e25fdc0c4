"""URL rules, near copies and nearest vectors against brute force."""
import random
import re

import numpy as np
from pyspark.sql import functions as F

from dayprints.llm import jaccard, neighbours, urls
from tests.llm.conftest import EDGE

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("example.org", "/en/", "allow"), ("com", "", "block"), ("a.com", "/x", "allow"),
         ("a.com", "/x", "block"), (None, "/", "block"), ("net", None, "block")]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if h is not None and p is not None
            and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[2:] if fits else (None, "allow"))


def test_url_verdicts(spark):
    some = [None, "", "example.org/es/", "http://EXAMPLE.org/es/1?x#y", "x://É.Com", "http://org/",
            "http://b.a.com/x/y", "http://a.com/x", "http://xa.com/x", "https://w.example.org/en/12",
            "https://w.example.org/en/2", "https://w.example.org/en", "http://a.com?x=/x", "://org/",
            "http://org", "a://b://org/", "http://a.com/x", "http://net/"]
    pages = spark.createDataFrame([(i % 15, u, "h") for i, u in enumerate(some)],
                                  "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted(tuple(r) for r in urls.judge(pages, rules).collect())
    assert [(*x[:3], x[4]) for x in got] == sorted(
        (i % 15, *judged(u)[:2], judged(u)[3]) for i, u in enumerate(some))
    assert {(x[1], x[2]): x[3] for x in got} == {judged(u)[:2]: judged(u)[2] for u in some}
    urls.LANE_ROWS, kept = 2, urls.LANE_ROWS  # a host in several lanes
    try:
        assert sorted(tuple(r) for r in urls.judge(pages, rules).collect()) == got
    finally:
        urls.LANE_ROWS = kept
    assert urls.judge(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}


def shingle_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    k = min(5, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute_groups(rows):
    sets = [(d, shingle_set(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(s), least.get(root(i), d)) for i, (d, s) in enumerate(sets)
                  if d is not None)


def near_copies(seed, size):
    rnd = random.Random(seed)
    rows, vocabulary = [], [f"w{i}" for i in range(60)]
    shared = " ".join(rnd.choice(vocabulary) for _ in range(12))
    for i in range(size):
        if i and rnd.random() < 0.65:
            words = rows[rnd.randrange(i)][1].split()
            for _ in range(rnd.randrange(3)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            text = " ".join(words) if rnd.random() < 0.8 else " ".join(words).upper() + "\n"
        else:
            text = " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 4, 6, 9, 25, 80])))
            text += " " + shared if rnd.random() < 0.4 else ""
        rows.append((i * 3 % size, text))
    return rows


def test_near_copies_for_every_boundary(docs, monkeypatch):
    for seed, boundary in ((1, None), (2, 0), (3, 1000), (4, 20)):
        if boundary is not None:
            monkeypatch.setattr(jaccard, "_boundary", lambda sets, b=boundary: b)
        rows = near_copies(seed, 150)
        got = jaccard.grouped(docs(rows).repartition(3)).collect()
        assert sorted(tuple(r) for r in got) == brute_groups(rows)
        monkeypatch.undo()


def test_near_copies_with_many_buckets_and_heavy_shingles(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET", 200)
    monkeypatch.setattr(jaccard, "CHUNK", 500)
    monkeypatch.setattr(jaccard, "_heavy", lambda described, documents: (
        np.sort(jaccard.shingles(" ".join(f"w{i}" for i in range(60)))), np.arange(56) + 100))
    rows = near_copies(7, 120) + [(1000 + i, " ".join(f"w{j}" for j in range(60 - i % 4)))
                                  for i in range(12)]
    got = jaccard.grouped(docs(rows).repartition(4)).collect()
    assert sorted(tuple(r) for r in got) == brute_groups(rows)


def test_frequent_shingles_are_counted(docs):
    rows = [(i, "one two three four five six " + str(i % 7)) for i in range(200)]
    described = jaccard.describe(docs(rows).repartition(2))
    values, counts = jaccard._heavy(described, 64)
    assert len(values) == 0  # copies within a task count once
    rows = [(i, f"one two three four five six {i}") for i in range(200)]
    values, counts = jaccard._heavy(jaccard.describe(docs(rows).repartition(2)), 200)
    assert set(jaccard.shingles("one two three four five six")) <= set(values)
    assert counts.max() <= 200
    assert sorted(tuple(r) for r in jaccard.grouped(docs(rows)).collect()) == brute_groups(rows)


def test_near_copies_edge_cases(docs):
    got = jaccard.grouped(docs(EDGE)).collect()
    assert len(got) == len(EDGE)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["n_shingles"] for i in (1, 2, 3)] == [0, 0, 0] and by[4]["component_id"] == 4
    assert by[None]["component_id"] is None
    assert jaccard.grouped(docs([])).collect() == []
    kept = jaccard.one_of_each(docs(EDGE))
    assert kept.columns == docs(EDGE).columns and kept.count() == len(EDGE)
    assert jaccard.one_of_each(docs([(2, "a b"), (1, "A  b"), (3, "c")])).select(
        "doc_id").orderBy("doc_id").collect() == [(1,), (3,)]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int") \
        .withColumn("list", F.lit("clash"))


def test_neighbours_are_near_and_exactly_measured(spark):
    rng = np.random.default_rng(3)
    data = rng.standard_normal((3000, 24)).astype(np.float32)
    data[1000:1900] = data[5]  # a large group of equal vectors
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(data)]
    rows += [(9000, None, 0), (9100, [0.0] * 24, 0), (9200, [float("nan")] * 24, 0),
             (9300, [None] + [1.0] * 23, 0), (9400, [float("inf")] * 24, 0), (9500, [1.0], 0)]
    rows.append(rows[100])  # a repeated row
    got = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0).toPandas()
    assert set(got.query_id) == set(range(0, 3000, 100))
    wide, found, all_of_them = data.astype(np.float64), 0, 0
    for query, part in got.groupby("query_id"):
        distance = np.sqrt(((wide - wide[query]) ** 2).sum(axis=1))
        distance[query] = np.inf
        best = np.lexsort((np.arange(3000), distance))[:10]
        part = part.sort_values("rank")
        assert list(part["rank"]) == list(range(1, 11)) and part.vec_id.is_unique
        assert np.allclose(distance[part.vec_id], part.score, rtol=0, atol=1e-12)
        found += len(set(best) & set(part.vec_id))
        all_of_them += 10
        if 1000 <= query < 1900:
            assert list(part.vec_id) == [i for i in [5, *range(1000, 1012)] if i != query][:10]
    assert found >= 0.9 * all_of_them


def test_few_or_no_vectors(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(4)]
    got = neighbours.nearest(vectors(spark, rows), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3]
    assert neighbours.nearest(vectors(spark, []), F.col("vec_id") == 0).collect() == []
    one = vectors(spark, [(1, [1.0], 0)])
    assert neighbours.nearest(one, F.col("vec_id") == 1).collect() == []
