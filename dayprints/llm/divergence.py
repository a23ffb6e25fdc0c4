"""How far each source's words diverge from those of other sources and of the language.

Terms are counted in numpy. Bytes of a term are packed big-endian: up to 8 into one uint64, up to
16 into two, both radix-sorted by 16-bit digits; longer terms go to one bucket per length, sorted
as bytes. Equal terms then lie in runs, which are counted. Texts lie in the order of their group,
and the sorts are stable, so that a run shows its groups and its documents too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayprints.llm.texts import lean
from dayprints.session import cut_lineage

UNIT = 1_000_000_000
SLICE = 4 << 20    # bytes of text counted together
KEPT = 400_000     # runs a task holds before it merges them, and gives them away if still so many

_BYTE = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTE >= 0x41) & (_BYTE <= 0x5A)
_LOWERED = np.where(_UPPER, _BYTE + 32, _BYTE).astype(np.uint8)
_IN_TERM = _UPPER | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)

COUNTED = "lang string, source string, term string, n long, docs long"


def audited(docs: DataFrame, min_docs: int = 3, top: int = 200, lang: str = "lang",
            source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): what sets each source apart.

    Null texts, langs and sources read as ''. Terms are runs of letters A-Z, a-z and of
    characters beyond ASCII, A-Z lower-cased. A language keeps the V terms that stand in at least
    ``min_docs`` of its documents (rows: a repeated row is a document of its own). A group, that
    is a source of a language, and the language as a whole give each kept term p = 1 +
    floor(UNIT * (count + 1) / (N + V)), N being its count of all kept terms, and two such
    figures diverge by floor((p - q)**2 / q). Part ``pair`` has for each group every other source
    of the language (q its p) with the sum over all kept terms; part ``term`` has for each group
    the ``top`` terms of its own that are more frequent in it than in the language. Ranks go by
    value, then by the item's bytes. Sources of a language without kept terms have pairs of 0;
    an empty table gives no rows; other columns are not read.

    Counting runs on whole texts inside tasks that merge their own counts first; one shuffle by
    (lang, term) adds them up, where a term has a row for each source and task at most. Sums over
    pairs need only the terms that both sources have: the rest follows from how often each count
    occurs in either, so no source is set against the whole vocabulary.
    """
    words = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                          for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    term = Window.partitionBy("lang", "term")
    counts = words.mapInArrow(_counted, COUNTED).repartition("lang", "term")
    kept = cut_lineage(
        counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"),
                                                     F.sum("docs").alias("docs"))
        .withColumns({"in_docs": F.sum("docs").over(term), "n_lang": F.sum("n").over(term),
                      "first": F.min("source").over(term) == F.col("source")})
        .where(F.col("in_docs") >= min_docs)
        .select("lang", "source", "term", "n", "n_lang", "first"))

    langs = kept.groupBy("lang").agg(F.sum("n").alias("n_all"),
                                     F.count_if("first").alias("v"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count("*").alias("terms"))
    groups = cut_lineage(
        words.select("lang", "source").distinct()
        .join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c)
                                    for c in ("own", "terms", "n_all", "v")])
        .withColumn("p0", _share(F.lit(0), F.col("own"), F.col("v"))))
    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "p0",
        _share(F.col("n"), F.col("own"), F.col("v")).alias("p"),
        _share(F.col("n_lang"), F.col("n_all"), F.col("v")).alias("q"))
    shares = cut_lineage(shares)

    terms = (shares.where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     _apart(F.col("p"), F.col("q")).alias("value")))
    by_rank = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = F.row_number().over(by_rank).alias("rank")
    return (_pairs(shares, groups).select("*", ranked)
            .unionByName(terms.select("*", ranked).where(F.col("rank") <= top)))


def _share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + v)); 1 where there are no kept terms."""
    whole = (n.cast("decimal(28,0)") + 1) * F.lit(UNIT)
    return F.coalesce(F.call_function("div", whole, F.nullif(total + v, F.lit(0))),
                      F.lit(0)).cast("long") + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, part, item, value) for every two sources of a language.

    With f the divergence, p0 and q0 the figures of a term that does not occur: the sum of f(p, q)
    over all terms is the sum of f(p, q0) over all terms, plus that of f(p0, q) - f(p0, q0) over
    the other's terms, plus that of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0) over common terms.
    The first two depend on counts alone: groups have few distinct ones.
    """
    f = _apart
    col = F.col
    other = groups.select("lang", col("source").alias("item"), col("p0").alias("q0"))
    differ = col("source") != col("item")
    alike = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("times"))
    absent = groups.select("lang", "source", col("p0").alias("p"), "p0",
                           (col("v") - col("terms")).alias("times"))
    of_one = (alike.unionByName(absent).join(other, "lang").where(differ)
              .groupBy("lang", "source", "item")
              .agg(F.sum(col("times") * f(col("p"), col("q0"))).alias("value")))
    of_other = (alike.select("lang", col("source").alias("item"), col("p").alias("q"),
                             col("p0").alias("q0"), "times")
                .join(groups.select("lang", "source", "p0"), "lang").where(differ)
                .groupBy("lang", "source", "item")
                .agg(F.sum(col("times") * (f(col("p0"), col("q")) - f(col("p0"), col("q0"))))
                     .alias("value")))
    twin = shares.select("lang", "term", col("source").alias("item"), col("p").alias("q"),
                         col("p0").alias("q0"))
    common = (shares.drop("q").join(twin, ["lang", "term"]).where(differ)
              .groupBy("lang", "source", "item")
              .agg(F.sum(f(col("p"), col("q")) - f(col("p"), col("q0")) - f(col("p0"), col("q"))
                         + f(col("p0"), col("q0"))).alias("value")))
    return (of_one.unionByName(of_other).unionByName(common)
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))


# ---- counting inside a task -----------------------------------------------------------------

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, source, term), and of the documents that hold it, of a task's texts."""
    held = Runs()
    for batch in lean(batches):
        for piece in _slices(batch):
            held.add(piece)
            if held.size > KEPT:
                held.merge()
                if held.size > KEPT // 2:
                    yield from held.batches()
                    held = Runs()
    held.merge()
    yield from held.batches()


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of some megabytes of text together; a longer text alone."""
    size = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = int(size[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + SLICE, "right")))
        yield batch.slice(at, to - at)
        at = to


class Runs:
    """Counted terms by width: 1 and 2 for packed words, else the length of the bytes.

    ``groups`` numbers the (lang, source) pairs seen by this task.
    """

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: dict[int, list] = {}
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> None:
        if batch.num_rows == 1 and pc.binary_length(batch.column(2))[0].as_py() > 2 * SLICE:
            self._add_long(batch)
            return
        pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        group = np.fromiter((self.groups.setdefault(p, len(self.groups)) for p in pairs),
                            dtype=np.int64, count=len(pairs))
        order = np.argsort(group, kind="stable")
        texts = batch.column(2).take(pa.array(order)).cast(pa.large_binary())
        for keys, doc in _terms(texts):
            n = np.ones(len(doc), dtype=np.int64)
            self._count(keys, group[order][doc], n, n, doc)

    def _add_long(self, batch: pa.RecordBatch) -> None:
        """One text in blocks that end between terms; it stays one document."""
        whole = np.frombuffer(batch.column(2)[0].as_buffer(), dtype=np.uint8)
        pair = (batch.column(0)[0].as_py(), batch.column(1)[0].as_py())
        group = self.groups.setdefault(pair, len(self.groups))
        own, at = Runs(), 0
        while at < len(whole):
            to = min(len(whole), at + SLICE)
            while to < len(whole) and _IN_TERM[whole[to]]:
                rest = np.flatnonzero(~_IN_TERM[whole[to:to + SLICE]])
                to = to + int(rest[0]) if len(rest) else min(len(whole), to + SLICE)
            for keys, doc in _terms(pa.array([whole[at:to].tobytes()], pa.large_binary())):
                n = np.ones(len(doc), dtype=np.int64)
                own._count(keys, np.full(len(doc), group), n, n, doc)
            own.merge()
            at = to
        for width, runs in own.parts.items():
            for keys, groups, n, _ in runs:
                self.parts.setdefault(width, []).append((keys, groups, n, np.ones_like(n)))
                self.size += len(n)

    def _count(self, keys, group, n, docs, doc=None) -> None:
        """Adds sorted runs of equal keys and groups; with ``doc``, documents count once each."""
        if not len(group):
            return
        order = _sorted_order(keys, group if doc is None else None)
        keys, group, n, docs = [k[order] for k in keys], group[order], n[order], docs[order]
        new = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]
        if doc is not None:
            doc = doc[order]
            docs = (new | np.r_[True, doc[1:] != doc[:-1]]).astype(np.int64)
        new |= np.r_[True, group[1:] != group[:-1]]
        at = np.flatnonzero(new)
        width = len(keys) if keys[0].dtype.kind == "u" else keys[0].dtype.itemsize
        run = ([k[at] for k in keys], group[at], np.add.reduceat(n, at), np.add.reduceat(docs, at))
        self.parts.setdefault(width, []).append(run)
        self.size += len(at)

    def merge(self) -> None:
        parts, self.parts, self.size = self.parts, {}, 0
        for runs in parts.values():
            keys = [np.concatenate(k) for k in zip(*[r[0] for r in runs], strict=True)]
            self._count(keys, *[np.concatenate([r[i] for r in runs]) for i in (1, 2, 3)])

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.groups:
            return
        langs, sources = (pa.array(x, pa.string()) for x in zip(*self.groups, strict=True))
        for runs in self.parts.values():
            for keys, group, n, docs in runs:
                number = pa.array(group)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(number), sources.take(number), _texts(keys), pa.array(n),
                     pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def _terms(texts: pa.Array) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(keys, document) of all terms: one uint64 word, two, then bytes of one length at a time."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset:texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return
    raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = _IN_TERM[raw]
    border = np.zeros(len(raw) + 1, dtype=bool)
    border[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
    length = ends - starts
    doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))
    low = np.r_[_LOWERED[raw], np.zeros(16, dtype=np.uint8)]
    for fewest, most in ((1, 8), (9, 16)):
        own = np.flatnonzero((length >= fewest) & (length <= most))
        if len(own):
            words = [_word(low, starts[own], np.minimum(length[own], 8))]
            if most > 8:
                words.append(_word(low, starts[own] + 8, length[own] - 8))
            yield words, doc[own]
    beyond = np.flatnonzero(length > 16)
    for width in np.unique(length[beyond]).tolist():
        own = beyond[length[beyond] == width]
        rows = np.lib.stride_tricks.sliding_window_view(low, width)[starts[own]]
        yield [np.ascontiguousarray(rows).view(f"S{width}").ravel()], doc[own]


def _word(low: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Up to 8 bytes as a big-endian number; the rest is zero, which no term holds."""
    rows = np.lib.stride_tricks.sliding_window_view(low, 8)[starts]
    words = np.ascontiguousarray(rows).view(">u8").ravel().astype(np.uint64)
    rest = (8 * (8 - length)).astype(np.uint64)
    return (words >> rest) << rest


def _sorted_order(keys: list[np.ndarray], group: np.ndarray | None) -> np.ndarray:
    """A stable order by the keys, then by the group if there is one."""
    order = np.arange(len(keys[0]))
    if group is not None:
        order = _by_digits(order, group.astype(np.uint64))
    if keys[0].dtype.kind != "u":
        return order[np.argsort(keys[0][order], kind="stable")]
    for word in reversed(keys):
        order = _by_digits(order, word)
    return order


def _by_digits(order: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Radix sort, least digit first; numpy sorts 16-bit numbers stably by counting."""
    for shift in range(0, 64, 16):
        digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
        if digit.min() != digit.max():
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def _texts(keys: list[np.ndarray]) -> pa.Array:
    """The terms as strings."""
    if keys[0].dtype.kind == "u":
        rows = np.stack([k.astype(">u8").view(np.uint8).reshape(-1, 8) for k in keys], axis=1)
        rows = rows.reshape(len(keys[0]), -1)
    else:
        rows = np.frombuffer(keys[0].tobytes(), dtype=np.uint8).reshape(len(keys[0]), -1)
    there = rows != 0
    offsets = np.r_[0, np.cumsum(there.sum(axis=1))].astype(np.int64)
    binary = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows[there])])
    return binary.cast(pa.large_string()).cast(pa.string())
