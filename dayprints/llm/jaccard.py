"""Jaccard join of word-shingle sets by a size-aware heavy-light join.

A document's set is its distinct shingles of five words; equal sets are one *class* (a 64-bit
digest with the size). Two classes link when 100 * |a & b| >= 75 * |a | b|.

Shingles are ordered by document frequency, counted over all classes; linked sets then share a
shingle among the first |a| - ceil(0.75 |a|) + 1 of each, and two among one more. Shingles of one
class only come first and never match, so most prefixes hold little else and are dropped. Sets up
to a boundary are *small*: they are listed under every pair of shingles of their longer prefix.
Larger ones are *large*: the inverted list of each single shingle of their prefix is scanned, and
small sets stand in these lists too, to be met by large ones only. The boundary is where the two
costs, numbers of subsets and lengths of lists, add up to the least.

In a list no pairs are formed at first. One member, the one with the fewest shingles of its own,
is compared with all others; those it links to are in one component with it. Only pairs with a
member that it does not link to are formed then, after bounds on size and position. Components
lose no link this way, and a group of m near copies costs m comparisons instead of m^2 / 2.

Frequencies are counted in buckets of hashes of bounded size. Shingles in at least one of
``HEAVY`` documents are found per task first and skip the buckets: they are last in the order by
their own counts. Equal copies are sent once per task.

Null, empty and blank texts have no set: size 0, linked with nothing, their own component.
Repeated rows of one document are copies. A null doc_id is kept as it is and never is a
component's id unless all its documents are null. Long texts are read whole, in blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayprints.llm.texts import lean
from dayprints.operators.components import components
from dayprints.session import cut_lineage

WORDS = 5
LEVEL, WHOLE = 75, 100
HEAVY = 500
BUCKET = 1_000_000
CHUNK = 1_000_000
TEXT_BLOCK = 1 << 22
LARGEST_SMALL = 256
COMPARISON = 8

_P, _A = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)
_LOW48 = np.uint64((1 << 48) - 1)


# ---------------------------------------------------------------- sets

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _M1
    h = (h ^ (h >> _SHIFT)) * _M2
    return h ^ (h >> _SHIFT)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(1023, _P))))


def _word_hashes(raw: bytes) -> np.ndarray:
    """A number for every word of a piece of text that does not cut words."""
    data = np.frombuffer(raw, np.uint8)
    inner = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inner, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    letters = _LOWER[data[inner]].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    powers = _POWERS
    if sizes.max() > len(powers):
        powers = np.cumprod(np.concatenate((np.ones(1, np.uint64),
                                            np.full(int(sizes.max()), _P))))
    return _mix(np.add.reduceat(letters * powers[place], first) + sizes.astype(np.uint64) * _A)


def _pieces(raw: bytes):
    """The text in blocks that end at white space."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + TEXT_BLOCK)
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit shingles of a text."""
    raw = (text or "").encode("utf-8")
    found = [_word_hashes(p) for p in _pieces(raw)]
    words = np.concatenate(found) if found else np.empty(0, np.uint64)
    if not len(words):
        return words
    size = min(WORDS, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = out * _A + words[i:len(words) - size + 1 + i]
    return np.unique(_mix(out))


def digest(found: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "big",
                          signed=True)


def _distinct_sets(batches, column: int, seen: set):
    """(digest, set) of the sets that this task has not had yet."""
    for batch in lean(batches):
        for value in batch.column(column):
            found = shingles(value.as_py())
            if len(found):
                sig = digest(found)
                if sig not in seen:
                    seen.add(sig)
                    yield sig, found


def describe(df: DataFrame) -> DataFrame:
    """From (doc_id, text), written out: (doc_id, n, sig) for every row; and, where ``shingle`` is
    not null, shingles that are frequent within a task with their counts there."""
    def measure(batches):
        seen: set = set()
        held, size = [], 0

        def frequent():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= max(3, len(held) / (2 * HEAVY))
            k = int(many.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                 pa.array(values[many].view(np.int64)), pa.array(counts[many].astype(np.int64))],
                names)

        names = ["doc_id", "n", "sig", "shingle", "tally"]
        for batch in lean(batches):
            sizes, sigs = [], []
            for value in batch.column(1):
                found = shingles(value.as_py())
                sig = digest(found) if len(found) else None
                sizes.append(len(found))
                sigs.append(sig)
                if sig is not None and sig not in seen:
                    seen.add(sig)
                    held.append(found)
                    size += len(found)
                    if size >= CHUNK:
                        yield frequent()
                        held, size = [], 0
            k = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sigs, pa.int64()),
                 pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names)
        if held:
            yield frequent()

    return cut_lineage(df.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        measure, "doc_id bigint, n bigint, sig bigint, shingle bigint, tally bigint"))


# ---------------------------------------------------------------- frequencies

def _heavy(described: DataFrame, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles, in order, that are in one of ``HEAVY`` documents or more, and their counts.

    There are at most HEAVY times the mean set size of them.
    """
    rows = (described.where("shingle is not null").groupBy("shingle")
            .agg(F.sum("tally").alias("tally"))
            .where(F.col("tally") >= max(64, documents // HEAVY)).toArrow())
    values = rows["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], rows["tally"].to_numpy()[order]


def _key(low: np.ndarray, bucket) -> np.ndarray:
    """A shingle's number: its bucket above its last 48 bits."""
    return low | (np.uint64(bucket) & np.uint64(0x7FFF)) << np.uint64(48)


_RECORD = np.dtype([("key", "<u8"), ("order", "<i8")])
_CLASS = np.dtype([("sig", "<i8"), ("n", "<i8")])


def _bucketed(df: DataFrame, heavy: tuple, buckets: int) -> DataFrame:
    """(bucket, kind, sigs, sizes, counts, hashes): the sets of all documents, dealt by hash.

    ``sizes`` are those of the sets, ``counts`` tells how many hashes here belong to each. kind 0 holds light shingles, six bytes each; kind 1 holds heavy ones as finished records,
    which wait in the bucket of their class.
    """
    shared = df.sparkSession.sparkContext.broadcast(heavy)

    def deal(batches):
        values, tallies = shared.value
        sigs, sizes, sets, size, held_heavy = [], [], [], 0, {}

        def rows():
            hashes = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            bucket = ((hashes >> _SHIFT) * np.uint64(buckets) >> np.uint64(31)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            hashes, owner, bucket = hashes[order], owner[order], bucket[order]
            names, wholes = np.array(sigs, np.int64), np.array(sizes, "<u4")
            edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
            low = (hashes & _LOW48).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            out = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                who, counts = np.unique(owner[a:b], return_counts=True)
                out.append((int(bucket[a]), 0, names[who].tobytes(), wholes[who].tobytes(),
                            counts.astype("<u4").tobytes(), low[a:b].tobytes()))
            return out

        def flush():
            out = rows() if size else []
            for bucket, parts in held_heavy.items():
                out.append((bucket, 1, np.array([s for s, _, _ in parts], np.int64).tobytes(),
                            np.array([n for _, n, _ in parts], "<u4").tobytes(),
                            np.array([len(r) for _, _, r in parts], "<u4").tobytes(),
                            b"".join(r.tobytes() for _, _, r in parts)))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                     *[pa.array(c, pa.binary()) for c in columns[2:]]],
                    ["bucket", "kind", "sigs", "sizes", "counts", "hashes"])

        for sig, found in _distinct_sets(batches, 0, set()):
            sizes.append(len(found))
            if len(values):
                at = np.minimum(np.searchsorted(values, found), len(values) - 1)
                known = values[at] == found
                if known.any():
                    records = np.empty(int(known.sum()), _RECORD)
                    records["key"] = _key(found[known] & _LOW48, 0x7FFF)
                    records["order"] = tallies[at[known]] + (1 << 40)
                    held_heavy.setdefault(sig % buckets, []).append((sig, sizes[-1], records))
                    size += len(records)
                    found = found[~known]
            sigs.append(sig)
            sets.append(found)
            size += len(found)
            if size >= CHUNK:
                yield from flush()
                sigs, sizes, sets, size, held_heavy = [], [], [], 0, {}
        if sets:
            yield from flush()

    return df.select("text").mapInArrow(
        deal, "bucket bigint, kind int, sigs binary, sizes binary, counts binary, hashes binary")


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal values."""
    if not len(values):
        return []
    edges = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _shared(table: pa.Table, groups: int) -> pa.Table:
    """(group, sigs, sizes, records) of the shingles of one bucket that two classes or more have,
    a row for each group of classes; one entry of all three for each shingle of a class."""
    bucket = table["bucket"][0].as_py()
    light, owners, records, known = [], [], [], []
    for row in range(table.num_rows):
        value = {c: table[c][row].as_buffer() for c in ("sigs", "sizes", "counts", "hashes")}
        who = np.empty(len(value["sigs"]) // 8, _CLASS)
        who["sig"] = np.frombuffer(value["sigs"], "<i8")
        who["n"] = np.frombuffer(value["sizes"], "<u4")
        who = np.repeat(who, np.frombuffer(value["counts"], "<u4"))
        if table["kind"][row].as_py():
            records.append(np.frombuffer(value["hashes"], _RECORD))
            known.append(who)
        else:
            wide = np.zeros((len(who), 8), np.uint8)
            wide[:, :6] = np.frombuffer(value["hashes"], np.uint8).reshape(-1, 6)
            light.append(wide.view("<u8").ravel())
            owners.append(who)
    if light:
        hashes, who = np.concatenate(light), np.concatenate(owners)
        order = np.lexsort((who["sig"], hashes))
        hashes, who = hashes[order], who[order]
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1])
                              | (who["sig"][1:] != who["sig"][:-1])))
        hashes, who = hashes[new], who[new]  # a copy may come from several tasks
        group = np.cumsum(np.concatenate(([True], hashes[1:] != hashes[:-1]))) - 1
        times = np.bincount(group)[group]
        many = times >= 2
        found = np.empty(int(many.sum()), _RECORD)
        found["key"], found["order"] = _key(hashes[many], bucket), times[many]
        records.append(found)
        known.append(who[many])
    found, who = np.concatenate(records), np.concatenate(known)
    group = who["sig"] % groups
    order = np.argsort(group, kind="stable")
    found, who, group = found[order], who[order], group[order]
    runs = _runs(group)
    return pa.table({
        "group": pa.array([int(group[a]) for a, _ in runs], pa.int64()),
        "classes": pa.array([who[a:b].tobytes() for a, b in runs], pa.binary()),
        "records": pa.array([found[a:b].tobytes() for a, b in runs], pa.binary())})


def _ordered(table: pa.Table) -> pa.Table:
    """The classes of one group with their shared shingles and prefixes; see ``_sets``."""
    who = np.concatenate([np.frombuffer(x.as_buffer(), _CLASS) for x in table["classes"]])
    records = np.concatenate([np.frombuffer(x.as_buffer(), _RECORD) for x in table["records"]])
    order = np.lexsort((records["key"], who["sig"]))
    who, records = who[order], records[order]
    out = []
    for a, b in _runs(who["sig"]):
        sig, n = who[a]
        part = records[a:b]
        part = part[np.concatenate(([True], part["key"][1:] != part["key"][:-1]))]
        own = int(n) - len(part)
        count = int(n) + (-LEVEL * int(n) // WHOLE) + 2 - own  # of the longer prefix
        if count >= 1 and n >= 2:
            first = part[np.lexsort((part["key"], part["order"]))][:count]
            out.append((int(sig), int(n), own, part["key"].view(np.int64),
                        first["key"].view(np.int64)))
    columns = list(zip(*out, strict=True)) if out else [()] * 5
    longs = pa.list_(pa.int64())
    kinds = (pa.int64(), pa.int64(), pa.int64(), longs, longs)
    return pa.table({name: pa.array(list(c), kind) for name, c, kind in zip(
        ("sig", "n", "own", "shared", "prefix"), columns, kinds, strict=True)})


def _sets(df: DataFrame, heavy: tuple, total: int) -> DataFrame:
    """Written out: (sig, n, own, shared, prefix) of the classes that share a shingle within
    their prefix.

    ``own`` counts the shingles of this class alone, ``shared`` holds the others in numeric
    order, ``prefix`` the first of them in the order of frequency, up to the longer prefix.
    """
    parts = max(1, -(-total // BUCKET))

    def shared(table: pa.Table) -> pa.Table:
        return _shared(table, parts)

    rows = (_bucketed(df, heavy, parts).groupBy("bucket")
            .applyInArrow(shared, "group bigint, classes binary, records binary"))
    return cut_lineage(rows.groupBy("group").applyInArrow(
        _ordered, "sig bigint, n bigint, own bigint, shared array<bigint>, prefix array<bigint>"))


# ---------------------------------------------------------------- lists

def _boundary(sets: DataFrame) -> int:
    """The size up to which subsets cost less than inverted lists.

    A subset is a row. An entry of an inverted list is a row and a comparison with the middle of
    its list, which costs as much as ``COMPARISON`` rows; two members of a list of subsets share
    two rare shingles and mostly link, so that comparison is needed anyway.
    """
    k = F.size("prefix")
    rows = (sets.where(F.col("n") <= LARGEST_SMALL).groupBy("n")
            .agg(F.sum(k * (k - 1) / 2).alias("subsets"),
                 F.sum((k - 1) * (1 + COMPARISON)).alias("lists"))
            .orderBy("n").collect())  # at most LARGEST_SMALL rows
    best, gain, total = 0, 0.0, 0.0
    for row in rows:
        total += row["lists"] - row["subsets"]
        if total > gain:
            best, gain = row["n"], total
    return best


def _entries(sets: DataFrame, boundary: int) -> DataFrame:
    """(key, sig, n, own, small, rest): the lists, ``rest`` bounding the overlap of a pair that
    meets here first."""
    n, own, prefix = F.col("n"), F.col("own"), F.col("prefix")
    numbered = F.transform(prefix, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    pairs = F.flatten(F.transform(numbered, lambda b: F.transform(
        F.slice(numbered, F.lit(1), b["i"]), lambda a: F.struct(
            F.xxhash64(a["x"], b["x"]).alias("key"), (n - own - b["i"] + 1).alias("rest")))))
    least = F.ceil(n * LEVEL / WHOLE)
    single = F.transform(
        F.slice(numbered, F.lit(1), F.greatest(F.lit(0), n - least + 1 - own).cast("int")),
        lambda a: F.struct(a["x"].alias("key"), (n - own - a["i"]).alias("rest")))
    small = n <= boundary
    subsets = sets.where(small & (F.size(prefix) >= 2)).select(
        "sig", "n", "own", F.lit(False).alias("small"), F.inline(pairs))
    reach = WHOLE * n >= LEVEL * (boundary + 1)  # a large set may link to it
    lists = sets.where(~small | reach).select("sig", "n", "own", small.alias("small"),
                                              F.inline(single))
    return subsets.unionByName(lists)


def _possible(a: str, b: str) -> Column:
    """May the members a, b of a list link, by size and by what is left behind their place?"""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = F.ceil((n + m) * LEVEL / (LEVEL + WHOLE))
    return ((WHOLE * n >= LEVEL * m) & (WHOLE * m >= LEVEL * n)
            & (need <= F.col(f"{a}.rest")) & (need <= F.col(f"{b}.rest"))
            & ~(F.col(f"{a}.small") & F.col(f"{b}.small")))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of the pairs that link, compared on the shingles they share."""
    def side(c):
        return sets.select(F.col("sig").alias(c), F.col("n").alias(f"n_{c}"),
                           F.col("shared").alias(f"shared_{c}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("shared_a", "shared_b"))
    rows = both.withColumn("common", common)
    return rows.where(WHOLE * F.col("common") >= LEVEL * (
        F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def links(sets: DataFrame) -> DataFrame:
    """(a, b): links between classes, enough of them that components are whole."""
    entries = _entries(sets, _boundary(sets))
    pivot = F.min(F.struct("small", "own", "n", "sig", "rest"))
    lists = entries.groupBy("key").agg(pivot.alias("p"), F.count(F.lit(1)).alias("members"))
    lists = lists.where((F.col("members") > 1) & ~F.col("p.small")).drop("members")
    listed = cut_lineage(entries.join(lists, "key"))
    e = listed.alias("e")
    rays = (e.where((F.col("e.sig") != F.col("e.p.sig")) & _possible("e", "e.p"))
            .select(F.col("e.p.sig").alias("a"), F.col("e.sig").alias("b")).distinct())
    stars = cut_lineage(_linked(rays, sets))
    # pairs that the star of their list does not settle: one of them is not linked to its middle
    others = listed.where(F.col("sig") != F.col("p.sig"))
    far = others.join(stars.select(F.col("a").alias("_a"), F.col("b").alias("_b")),
                      (F.col("p.sig") == F.col("_a")) & (F.col("sig") == F.col("_b")), "left_anti")
    far = cut_lineage(far.select("key", "sig", "n", "small", "rest"))
    busy = far.select("key").distinct()
    near = others.select("key", "sig", "n", "small", "rest").join(busy, "key", "left_semi")
    f, o = far.alias("f"), near.alias("o")
    met = f.join(o, (F.col("f.key") == F.col("o.key")) & (F.col("f.sig") != F.col("o.sig"))
                 & _possible("f", "o"))
    rest = met.select(F.least("f.sig", "o.sig").alias("a"),
                      F.greatest("f.sig", "o.sig").alias("b")).distinct()
    return stars.unionByName(_linked(rest, sets))


def grouped(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    described = describe(rows)
    members = described.where("shingle is null").select("doc_id", "n", "sig")
    size = members.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total")).first()
    classes = cut_lineage(members.where("sig is not null").groupBy("sig", "n")
                          .agg(F.min("doc_id").alias("least")))
    sets = _sets(rows, _heavy(described, size["rows"]), size["total"] or 0)
    found = components(links(sets))
    labelled = classes.join(found.withColumnsRenamed({"node": "sig", "component": "label"}), "sig",
                            "left").withColumn("label", F.coalesce("label", "sig"))
    lowest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = labelled.join(lowest, "label").select("sig", "component_id")
    return members.join(ids, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of one document of each component, the one with the smallest id."""
    kept = grouped(df, doc_id, text).where("doc_id <=> component_id").select(
        F.col("doc_id").alias("_kept")).distinct()
    return df.join(kept, df[doc_id].eqNullSafe(F.col("_kept")), "left_semi")
