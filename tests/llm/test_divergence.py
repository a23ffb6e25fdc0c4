"""The audit of sources against plain loops over the whole vocabulary."""

import random
import re
from collections import Counter

from dayprints.llm import divergence
from tests.llm.conftest import EDGE, LONG

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs=3, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        own = [(s, TERM.findall(t.translate(LOWER))) for x, s, t in rows if x == lang]
        in_docs = Counter(w for _, words in own for w in set(words))
        kept = {w for w, n in in_docs.items() if n >= min_docs}
        counts = {s: Counter() for s, _ in own}
        for s, words in own:
            counts[s].update(w for w in words if w in kept)

        def shares(count):
            total = sum(count.values())
            return {w: 1 + 10**9 * (count[w] + 1) // (total + len(kept)) for w in kept}
        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in p:
            pairs = [(sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o)
                     for o in p if o != s]
            terms = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in kept
                     if counts[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in
                        enumerate(found) if part == "pair" or i < top}
    return out


def audit(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "lang string, source string, text string, n int, term string")
    got = divergence.audited(df.repartition(3), **options).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def words(rng, n):
    stems = ["ab", "Ab", "é", "中文", "abcdefgh", "abcdefghi", "abcdefghabcdefgh", "b" * 17,
             "Straße" * 4, "c" * 40, "z"]
    return rng.choice([" ", ", ", "1"]).join(rng.choice(stems) + rng.choice(["", "x", "yy"])
                                             for _ in range(n))


def test_equals_plain_loops(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "", None]),
             words(rng, rng.randrange(60))) for _ in range(150)]
    assert audit(spark, rows) == plain(rows)
    assert audit(spark, rows, top=4) == plain(rows, top=4)


def test_edges(spark):
    rows = [("en", "s", text) for _, text in EDGE] + [("en", None, None), (None, None, None),
                                                      ("fr", "lone", "a a a")]
    rows += [("en", "t", LONG), ("en", "t", "AB c ab"), ("en", "t", "AB c ab")]
    assert audit(spark, rows) == plain(rows)
    assert audit(spark, rows[:1]) == set()


def test_no_kept_terms_still_pairs(spark):
    rows = [("en", "a", "one"), ("en", "b", None)]
    assert audit(spark, rows) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_slices_blocks_and_merges_count_alike(monkeypatch):
    import pyarrow as pa
    rng = random.Random(5)
    texts = [words(rng, n) for n in (0, 3, 200, 1000)] + ["q" * 5000 + " ab"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en", "de", "en", "en", "de"]), pa.array(["a"] * 5), pa.array(texts)],
        ["lang", "source", "text"])

    def counts():
        total = Counter(), Counter()
        for part in divergence._counted([batch]):
            for row in part.to_pylist():
                key = row["lang"], row["source"], row["term"]
                total[0][key] += row["n"]
                total[1][key] += row["docs"]
        return total

    expected = counts()
    monkeypatch.setattr(divergence, "SLICE", 300)
    monkeypatch.setattr(divergence, "KEPT", 5)
    assert counts() == expected
    direct = Counter((lang, "a", w) for lang, t in zip("en de en en de".split(), texts, strict=True)
                     for w in TERM.findall(t.translate(LOWER)))
    assert expected[0] == direct
