"""Benchmark decontamination: word n-grams as seeds, local alignment as the judge.

The benchmark is the query set; it is taken in blocks of bounded size, each of which is broadcast
and compared with all documents. A seed is three words of an item in a row, or four around a gap
(``SHAPES``), so that a copy in which every third or fourth word is another one keeps seeds too.
Every seed that a document shares with an item counts, however frequent it is: the result for a
document does not depend on the rest of the corpus. Common
phrases cost little, as a passage can reach the threshold only if it holds that share of the
item's words; this is counted before anything is aligned, over the document and then over the
passage. The passage around a seed is aligned with the item (Smith-Waterman over words: match 2,
mismatch -1, gap -1). The score is the alignment's share of a perfect copy's; edited copies lose
1.5 times the share of words changed. It must be worth ``N`` words at least.

Words are runs of letters, digits and underscores, case-folded; in scripts without spaces (Han,
Kana, Thai, Lao, Khmer, Burmese) each character is a word. An item of fewer than four words is one
seed as a whole and is found where its words stand in a row, also a single word. Null and empty
texts and items without words match nothing. Repeated documents are judged row by row,
repeated item ids item by item. A document is read whole; only a few rows of the alignment are
in memory, for windows of some item lengths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from dayprints.llm.texts import lean

N = 4  # shorter items are sought as a whole
SHAPES = ((0, 1, 2), (0, 1, 3, 4))
THRESHOLD = 0.5
BLOCK_CHARS = 8_000_000
PAIRS = 1 << 20  # seeds of a document looked at together
MATCH, MISMATCH, GAP = 2, -1, -1
_WORD = re.compile(r"\w+")
_UNSPACED = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029"
             "\u3031-\u3035\u303b\u303c\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
             "\ua9e0-\ua9ff\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f"
             "\U00020000-\U0003ffff")
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORD_OR_SIGN = re.compile(rf"[^\W{_UNSPACED}]+|(?=\w)[{_UNSPACED}]")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    folded = (text or "").casefold()
    spaced = folded.isascii() or not _ANY_UNSPACED.search(folded)
    return (_WORD if spaced else _WORD_OR_SIGN).findall(folded)


def gram_keys(ids: np.ndarray, places: tuple[int, ...] = SHAPES[0]) -> np.ndarray:
    """A number for the words at ``places`` behind each word; ids are 64-bit and not 0."""
    size = len(ids) - places[-1]
    if size <= 0:
        return np.empty(0, np.uint64)
    key = ids[:size] + np.uint64(sum(1 << p for p in places) << 40)
    for i in places[1:]:
        key = (key * _FACTOR) ^ (key >> np.uint64(29))
        key += ids[i:i + size]
    return key


def blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """(item_id, words) of the items with any words, a bounded number of characters at a time."""
    block, size = [], 0
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("t is not null")
    for row in rows.orderBy("i", "t").toLocalIterator():
        found = words(row["t"])
        if found:
            block.append((row["i"], found))
            size += len(row["t"])
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _row(n: int) -> tuple[int, ...]:
    return tuple(range(n))


class Index:
    """A block of items: word numbers, seeds in order, and where each n-gram stands."""

    def __init__(self, block: list[tuple]):
        self.number: dict[str, int] = {}
        for _, found in block:
            for word in found:
                self.number.setdefault(word, len(self.number) + 1)
        self.items = [(i, np.array([self.number[w] for w in found], np.uint64))
                      for i, found in block]
        keys, self.starts = [], []  # seeds of each item and where they begin
        for _, ids in self.items:  # none for short items
            own = [gram_keys(ids, shape) for shape in SHAPES]
            keys.append(np.concatenate(own))
            self.starts.append(np.concatenate([np.arange(len(k)) for k in own]))
        self.grams = np.unique(np.concatenate(keys))
        self.of_item = [np.searchsorted(self.grams, k) for k in keys]
        self.short: dict[tuple, list] = {}  # words of an item below N: its numbers
        for number, (_, ids) in enumerate(self.items):
            if len(ids) < N:
                self.short.setdefault(tuple(ids.tolist()), []).append(number)
        self.short_keys = {n: np.unique(np.array([gram_keys(np.array(k, np.uint64), _row(n))[0]
                                                  for k in self.short if len(k) == n]))
                           for n in sorted({len(k) for k in self.short})}

    def ids(self, text: str | None) -> np.ndarray:
        get = self.number.get
        found = words(text)
        return np.fromiter((get(w, 0) for w in found), np.uint64, len(found))

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a text, and the seeds of the block that stand there."""
        known = ids != 0
        none = np.empty(0, np.int64)
        places, grams = [none], [none]
        for shape in SHAPES if len(self.grams) else ():
            size = len(ids) - shape[-1]
            if size <= 0:
                continue
            whole = known[:size].copy()
            for i in shape[1:]:
                whole &= known[i:i + size]
            there = np.flatnonzero(whole)
            keys = gram_keys(ids, shape)[there]
            at = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
            right = self.grams[at] == keys
            places.append(there[right])
            grams.append(at[right])
        return np.concatenate(places), np.concatenate(grams)

    def short_hits(self, ids: np.ndarray) -> dict[int, int]:
        """Numbers of the short items that stand in a text as a whole, and the first place."""
        out: dict[int, int] = {}
        for n, sought in self.short_keys.items():
            keys = gram_keys(ids, _row(n))
            at = np.minimum(np.searchsorted(sought, keys), len(sought) - 1)
            places = np.flatnonzero(sought[at] == keys)
            _, first = np.unique(keys[places], return_index=True)
            for place in places[first].tolist():
                for number in self.short.get(tuple(ids[place:place + n].tolist()), ()):
                    out[number] = place
        return out


def _index(shared) -> Index:
    kept = shared.value
    if "index" not in kept:
        kept["index"] = Index(kept["block"])
    return kept["index"]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and where it ends in the passage (exclusive)."""
    best, end = 0, 0
    steps = np.arange(1, len(passage) + 1)
    above = np.zeros(len(passage) + 1, np.int64)
    for word in item:
        diagonal = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        here = np.maximum(np.maximum(diagonal, above[1:] + GAP), 0)
        # gaps along the row: the best of here[j] + GAP * (k - j) for j <= k
        here = np.maximum.accumulate(here - GAP * steps) + GAP * steps
        place = int(here.argmax())
        if here[place] > best:
            best, end = int(here[place]), place + 1
        above = np.concatenate(([0], here))
    return best, end


class Judge:
    """Finds the items that a text holds."""

    def __init__(self, index: Index):
        self.index = index
        sizes = np.array([len(grams) for grams in index.of_item], np.int64)
        gram = np.concatenate(index.of_item)
        order = np.argsort(gram, kind="stable")
        self.gram = gram[order]
        self.item = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.place = np.concatenate(index.starts)[order]
        self.words = np.concatenate([item for _, item in index.items]).astype(np.int64)
        self.size = np.array([len(item) for _, item in index.items], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.held = np.zeros(len(index.number) + 1, bool)  # words of a passage; else all False

    def _postings(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``gram``, ``item`` and ``place`` for each n-gram, and how many each one has."""
        first = np.searchsorted(self.gram, grams, "left")
        many = np.searchsorted(self.gram, grams, "right") - first
        return np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum()), many

    def _likely(self, ids: np.ndarray, grams: np.ndarray, threshold: float) -> np.ndarray:
        """A flag for each item that shares an n-gram and enough words with the document."""
        flags = np.zeros(len(self.size), bool)
        items = np.unique(self.item[self._postings(np.unique(grams))[0]])
        sizes = self.size[items]
        ends = np.cumsum(sizes)
        at = np.repeat(self.begin[items] - ends + sizes, sizes) + np.arange(ends[-1])
        known = ids[ids != 0].astype(np.int64)
        self.held[known] = True
        shared = np.add.reduceat(self.held[self.words[at]].astype(np.int64), ends - sizes)
        self.held[known] = False
        flags[items[shared >= threshold * sizes]] = True
        return flags

    def _holds(self, item: np.ndarray, passage: np.ndarray, threshold: float) -> bool:
        """Does a passage hold enough of an item's words to reach the threshold?"""
        known = passage[passage != 0].astype(np.int64)
        self.held[known] = True
        shared = np.count_nonzero(self.held[item.astype(np.int64)])
        self.held[known] = False
        return shared >= threshold * len(item)

    def _anchors(self, ids: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of items, and where in the text each would begin; in order, without repeats."""
        places, grams = self.index.hits(ids)
        none = np.empty(0, np.int64)
        if not len(places):
            return none, none
        likely = self._likely(ids, grams, threshold)
        if not likely.any():
            return none, none
        spread = np.searchsorted(self.gram, grams, "right") - np.searchsorted(self.gram, grams)
        cuts = np.flatnonzero(np.diff(np.cumsum(spread) // PAIRS)) + 1
        pairs = np.empty((2, 0), np.int64)
        for part, there in zip(np.split(grams, cuts), np.split(places, cuts), strict=True):
            rows, many = self._postings(part)
            kept = likely[self.item[rows]]
            anchors = np.repeat(there, many)[kept] - self.place[rows[kept]]
            pairs = np.concatenate((pairs, (self.item[rows[kept]], anchors)), axis=1)
        items, anchors = pairs
        order = np.lexsort((anchors, items))
        items, anchors = items[order], anchors[order]
        new = np.ones(len(items), bool)
        new[1:] = (items[1:] != items[:-1]) | (anchors[1:] != anchors[:-1])
        return items[new], anchors[new]

    def found(self, text: str | None, threshold: float) -> list[dict]:
        ids = self.index.ids(text)
        out, open_item, until, best = [], -1, 0, None
        items, anchors = self._anchors(ids, threshold)
        for number, start in zip(items.tolist(), anchors.tolist(), strict=True):
            item_id, item = self.index.items[number]
            if number != open_item:
                open_item, until, best = number, -len(ids) - len(item), None
            if start <= until:  # inside the window that was looked at
                continue
            slack = len(item) // 2 + N
            low = max(0, start - slack)
            until = start + len(item) // 2
            high = min(len(ids), until + len(item) + slack)
            if not self._holds(item, ids[low:high], threshold):
                continue
            score, end = align(item, ids[low:high])
            share = score / (MATCH * len(item))
            if share >= threshold and score >= MATCH * N and (best is None or share > best["score"]):
                if best is None:
                    best = {}
                    out.append(best)
                best.update(item_id=item_id, score=share, end_word=low + end)
        for number, place in sorted(self.index.short_hits(ids).items()):
            item_id, item = self.index.items[number]
            out.append({"item_id": item_id, "score": 1.0, "end_word": place + len(item)})
        return out


def found_items(text: Column, benchmark: DataFrame, threshold: float = THRESHOLD,
                item_id: str = "item_id", item_text: str = "text") -> Column:
    """array<struct(item_id, score, end_word)> of the items that each text holds.

    ``end_word`` counts words of the document up to the end of the aligned passage.
    """
    spark = benchmark.sparkSession
    kind = benchmark.schema[item_id].dataType
    columns = []
    for block in blocks(benchmark, item_id, item_text):
        shared = spark.sparkContext.broadcast({"block": block})
        columns.append(_found(text, shared, kind, threshold))
    empty = F.array().cast(_result(kind))
    return F.concat(*columns) if columns else empty


def _result(kind: DataType) -> str:
    return f"array<struct<item_id:{kind.simpleString()},score:double,end_word:bigint>>"


def _found(text: Column, shared, kind: DataType, threshold: float) -> Column:
    arrow = pa.list_(pa.struct([("item_id", to_arrow_type(kind)), ("score", pa.float64()),
                                ("end_word", pa.int64())]))

    @F.arrow_udf(_result(kind))
    def find(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept = shared.value
        if "judge" not in kept:
            kept["judge"] = Judge(_index(shared))
        judge = kept["judge"]
        for part in lean(parts):
            yield pa.array([judge.found(v.as_py(), threshold) for v in part], arrow)

    return find(text)


def contaminated(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                 text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, end_word): a row for each item that a document holds."""
    found = found_items(F.col("_text"), benchmark, threshold)
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    return rows.select("doc_id", F.explode(found).alias("hit")).select("doc_id", "hit.*")


def clean(documents: DataFrame, benchmark: DataFrame, text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, that hold no item of the benchmark."""
    return documents.where(F.size(found_items(F.col(text), benchmark, threshold)) == 0)
