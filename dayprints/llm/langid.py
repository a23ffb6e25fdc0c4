"""Language identification by interpolated Kneser-Ney character models.

Training counts every character 4-gram of all training texts; discounts, continuation counts
and context weights follow as grouped sums. The model is a table (lang, kind, size, gram, value)
in the shared folder: log probabilities of grams and log weights of contexts. A character is a
UTF-16 code unit (two for those beyond the basic plane), so four fit in 64 bits and no two texts
of letters share their grams. The model grows with the distinct grams of the corpus.

Scoring takes blocks of the model in turn: at most ``LANGUAGES_A_PASS`` languages and
``PASS_BYTES``; a language beyond that is divided by the character before a gram's last one. A
block goes through the driver to the workers, which look its grams up in arrays sorted by hash,
and leaves before the next one comes. With one block, as a rule, texts are read once; with more,
each block's sums per text are written and added afterwards.

Letters are lower-cased, everything else is one space. A text's language is the one with the
lowest cross-entropy per character, ties by name. A text without letters is ``und``. A text is
``accepted`` if its cross-entropy is not far beyond that of the training texts of the language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayprints.llm.texts import code_points, free_name, is_letter, lean, struct_array
from dayprints.session import cut_lineage

ORDER = 4
BITS = 16
ALPHABET = 1 << BITS
BLOCK = 1 << 20  # characters of a text looked at together
LANGUAGES_A_PASS = 16
PASS_BYTES = 64 << 20
ENOUGH = 20  # texts of 20 or more characters from which a language's limit is taken
USUAL = (2.5, 4.0, 0.05, 8.0)  # the limit where no language has that many
MARGIN = 0.5  # nats per character above the language's mean that are always accepted
UNKNOWN = "und"


class Letters:
    """Texts as numbers: blocks of code units, each starting with the last three of the block
    before, or three spaces."""

    def __init__(self):
        self.flags = is_letter()

    def blocks(self, text: str) -> Iterator[np.ndarray]:
        tail, after_letter, seen = np.full(ORDER - 1, 32, np.uint64), False, False
        for start in range(0, len(text), BLOCK):
            codes = code_points(text[start:start + BLOCK].lower())
            letter = self.flags[codes]
            keep = letter.copy()
            keep[1:] |= letter[:-1]
            keep[:1] |= after_letter
            after_letter = bool(letter[-1]) if len(letter) else after_letter
            kept = _units(np.where(letter, codes, 32)[keep])
            if len(kept):
                seen = True
                whole = np.concatenate((tail, kept))
                yield whole
                tail = whole[len(whole) - ORDER + 1:]
        if seen and after_letter:
            yield np.concatenate((tail, np.full(1, 32, np.uint64)))


def _units(codes: np.ndarray) -> np.ndarray:
    """UTF-16 code units of code points."""
    wide = codes >= ALPHABET
    if not wide.any():
        return codes.astype(np.uint64)
    units = np.repeat(codes, 1 + wide).astype(np.uint64)
    first = np.cumsum(1 + wide)[wide] - 2
    over = codes[wide].astype(np.uint64) - np.uint64(ALPHABET)
    units[first] = np.uint64(0xD800) + (over >> np.uint64(10))
    units[first + 1] = np.uint64(0xDC00) + (over & np.uint64(0x3FF))
    return units


def grams(block: np.ndarray, n: int) -> np.ndarray:
    """The n-gram that ends at each character after the first three."""
    key = np.zeros(len(block) - ORDER + 1, np.uint64)
    for i in range(ORDER - n, ORDER):
        key = key << np.uint64(BITS) | block[i:len(block) - ORDER + 1 + i]
    return key


# ---------------------------------------------------------------- training

def gram_counts(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, gram, n): 4-grams of all texts; rows with a null text or language are skipped.

    Each task adds up its own counts, so the shuffle carries one row per task and gram.
    """
    def count(batches):
        letters, held = Letters(), {}

        def add(name, keys, n):
            if name in held:
                keys, n = np.concatenate((held[name][0], keys)), np.concatenate((held[name][1], n))
                keys, place = np.unique(keys, return_inverse=True)
                n = np.bincount(place, weights=n).astype(np.int64)
            held[name] = keys, n

        def settle(pending):
            for name, keys in pending.items():
                add(name, *np.unique(np.concatenate(keys), return_counts=True))
            pending.clear()

        def rows():
            for name, (keys, n) in held.items():
                for at in range(0, len(keys), 100_000):
                    part = keys[at:at + 100_000].view(np.int64)  # Spark has no unsigned numbers
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(part)), pa.array(part),
                         pa.array(n[at:at + 100_000])], ["lang", "gram", "n"])

        for batch in lean(batches):
            pending: dict[str, list] = {}
            waiting = 0
            names = batch.column(0).to_pylist()
            for name, value in zip(names, batch.column(1), strict=True):
                for block in letters.blocks(value.as_py()):
                    keys = grams(block, ORDER)
                    pending.setdefault(name, []).append(keys)
                    waiting += len(keys)
                if waiting >= 4 * BLOCK:
                    settle(pending)
                    waiting = 0
            settle(pending)
            if sum(len(k) for k, _ in held.values()) > 4_000_000:
                yield from rows()
                held.clear()
        yield from rows()

    known = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    counted = known.mapInArrow(count, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _model_rows(counts: DataFrame) -> DataFrame:
    """(lang, kind, size, gram, value): log probabilities of grams and log weights of contexts."""
    low = {n: F.col("gram").bitwiseAND((1 << BITS * n) - 1) for n in range(1, ORDER)}
    by_size = {ORDER: cut_lineage(counts)}
    for n in range(ORDER - 1, 0, -1):  # how many different characters stand before the n-gram
        by_size[n] = (by_size[n + 1].groupBy("lang", low[n].alias("gram"))
                      .agg(F.count(F.lit(1)).alias("n")))
    shorter, out = None, []
    for n in range(1, ORDER + 1):
        rows = by_size[n].withColumn("context", F.shiftrightunsigned("gram", BITS))
        once, twice = (F.count_if(F.col("n") == k) for k in (1, 2))
        discount = rows.groupBy("lang").agg(
            F.greatest(F.lit(0.1), F.coalesce(F.try_divide(once, once + 2 * twice), F.lit(0.5)))
            .alias("d"))
        context = rows.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        context = context.join(discount, "lang").withColumn(
            "weight", F.col("d") * F.col("kinds") / F.col("total"))
        if n > 1:
            joined = rows.withColumn("rest", low[n - 1]).join(
                shorter.select("lang", F.col("gram").alias("rest"), F.col("p").alias("q")),
                ["lang", "rest"])
        else:
            joined = rows.withColumn("q", F.lit(1.0 / ALPHABET))
        joined = joined.join(context, ["lang", "context"])
        shorter = cut_lineage(joined.select("lang", "gram", (
            F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
            + F.col("weight") * F.col("q")).alias("p")))
        out.append(shorter.select("lang", F.lit("gram").alias("kind"), F.lit(n).alias("size"),
                                  "gram", F.log("p").alias("value")))
        out.append(context.select("lang", F.lit("context").alias("kind"),
                                  F.lit(n - 1).alias("size"),
                                  F.col("context").alias("gram"), F.log("weight").alias("value")))
    union = out[0]
    for part in out[1:]:
        union = union.unionByName(part)
    return union.withColumn("value", F.col("value").cast("float"))


@dataclass
class Model:
    """The written table and its blocks: (languages, part, parts)."""

    rows: DataFrame
    blocks: list[tuple[list[str], int, int]]

    @property
    def languages(self) -> list[str]:
        return sorted({name for names, _, _ in self.blocks for name in names})

    def arrays(self, block: tuple[list[str], int, int]) -> dict:
        """One block for the workers: per language {(kind, size): (grams, values)}."""
        names, part, parts = block
        rows = self.rows.where(F.col("lang").isin(names))
        if parts > 1:  # grams by their last character but one; single characters everywhere
            char = F.when(F.col("kind") == "gram", F.shiftrightunsigned("gram", BITS)).otherwise(
                F.col("gram")).bitwiseAND(ALPHABET - 1)
            single = F.col("size") <= (F.col("kind") == "gram").cast("int")
            rows = rows.where(single | (char % parts == part))
        table = rows.select("lang", "kind", "size", "gram", "value").toArrow().combine_chunks()
        model: dict = {name: {} for name in names}
        coded = table["lang"].combine_chunks().dictionary_encode()
        lang = coded.indices.to_numpy(zero_copy_only=False)
        kind = pc.equal(table["kind"], "gram").to_numpy()
        size, keys = table["size"].to_numpy(), table["gram"].to_numpy().view(np.uint64)
        values = table["value"].to_numpy().astype(np.float32)
        for number, name in enumerate(coded.dictionary.to_pylist()):
            for n in range(ORDER + 1):
                for which in (False, True):
                    own = np.flatnonzero((lang == number) & (size == n) & (kind == which))
                    if len(own):
                        model[name]["gram" if which else "context", n] = keys[own], values[own]
        return {"arrays": model, "part": part, "parts": parts}


def train(df: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """The model of all rows with a text and a language; without any it has no blocks."""
    rows = cut_lineage(_model_rows(gram_counts(df, lang, text)))
    sizes = {row["lang"]: 12 * row["count"] for row in rows.groupBy("lang").count().collect()}
    return Model(rows, passes(sizes))


def passes(sizes: dict[str, int]) -> list[tuple[list[str], int, int]]:
    """Blocks of languages, or parts of one, that take ``PASS_BYTES`` at most.

    Part k of n has the grams whose last character but one is k modulo n, and all single
    characters; it scores the characters behind such a one. A part is larger than the bound only
    where the grams around one character are.
    """
    out: list[tuple[list[str], int, int]] = []
    room = names = 0
    for name in sorted(sizes):
        parts = -(-sizes[name] // PASS_BYTES)
        if parts > 1:
            out += [([name], k, parts) for k in range(parts)]
            room = 0
            continue
        if sizes[name] > room or names == LANGUAGES_A_PASS:
            out.append(([], 0, 1))
            room, names = PASS_BYTES, 0
        out[-1][0].append(name)
        room, names = room - sizes[name], names + 1
    return out


def limits(df: DataFrame, lang: str = "lang", column: str = "language") -> dict:
    """How far a text's cross-entropy may lie above its language's mean, from scored rows.

    Taken from all rows of 20 or more characters that are predicted as their own language. A
    text's cross-entropy varies by the spread between texts and by that between its characters;
    the limit is the larger of 8 such deviations and twice the 95 % quantile of those seen, and
    at least ``MARGIN``. All figures are medians and quantiles, which a few percent of wrongly
    labelled texts hardly move. A language with fewer than ``ENOUGH`` texts takes the medians of
    the others' figures, or ``USUAL``; they stand under the key None.
    """
    rows = (df.select(F.col(lang).alias("_lang"), F.col(f"{column}.*"))
            .where("lang_pred = _lang and n_chars >= 20")
            .select("_lang", "entropy", "variance", "n_chars"))
    middle = rows.groupBy("_lang").agg(
        F.percentile_approx("entropy", 0.5).alias("mean"), F.count(F.lit(1)).alias("n"),
        F.percentile_approx("variance", 0.5).alias("chars")).where(F.col("n") >= ENOUGH)
    middle = F.broadcast(cut_lineage(middle))  # one row a language, as the next ones
    away = F.col("entropy") - F.col("mean")
    spread = rows.join(middle, "_lang").groupBy("_lang", "mean", "chars").agg(
        (F.percentile_approx(away * away, 0.5) * 2.2).alias("spread"))
    spread = F.broadcast(cut_lineage(spread))
    deviation = away / F.sqrt(F.col("spread") + F.col("chars") / F.col("n_chars") + 1e-4)
    found = rows.join(spread, "_lang").groupBy("_lang", "mean", "chars", "spread").agg(
        F.greatest(F.lit(8.0), 2 * F.percentile_approx(deviation, 0.95)).alias("most"))
    known = {row["_lang"]: tuple(row)[1:] for row in found.collect()}
    usual = np.median(list(known.values()), axis=0).tolist() if known else USUAL
    return {**known, None: tuple(usual)}


# ---------------------------------------------------------------- scoring

def by_hash(keys: np.ndarray) -> np.ndarray:
    """The keys in the order of their hashes."""
    return keys[np.argsort(keys * Rows.FACTOR)]


class Rows:
    """The places of keys that lie in the order of their hashes; ``absent`` for other keys.

    The hash is a one-to-one map of 64-bit numbers, so equal hashes are equal keys. Its first
    bits name a bucket of the array, less than one key on average.
    """

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        bits = max(4, len(keys).bit_length())
        self.shift, self.absent = np.uint64(64 - bits), len(keys)
        hashes = keys * self.FACTOR
        buckets = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.starts = np.searchsorted(hashes, buckets).astype(np.int32)
        self.hashes = np.append(hashes, np.uint64(2**64 - 1))

    def of(self, keys: np.ndarray) -> np.ndarray:
        wanted = keys * self.FACTOR
        out = self.starts[(wanted >> self.shift).astype(np.int64)]
        left = np.flatnonzero(self.hashes[out] < wanted)
        while len(left):
            out[left] += 1
            left = left[self.hashes[out[left]] < wanted[left]]
        out[self.hashes[out] != wanted] = self.absent
        return out


class Scorer:
    """The arrays of a block's languages; a gram is looked up once for all of them."""

    def __init__(self, block: dict):
        self.letters = Letters()
        self.part, self.parts = block["part"], block["parts"]
        model = block["arrays"]
        none = np.empty(0, np.uint64), np.empty(0, np.float32)
        self.rows, self.tables = {}, {name: {} for name in model}
        for size in range(ORDER + 1):
            held = {(name, kind): own.get((kind, size), none)
                    for name, own in model.items() for kind in ("gram", "context")}
            keys = by_hash(np.unique(np.concatenate([k for k, _ in held.values()])))
            self.rows[size] = Rows(keys)
            for (name, kind), (own_keys, values) in held.items():
                fill = np.nan if kind == "gram" else 0.0  # an unseen context has weight 1
                table = np.full(len(keys) + 1, fill, np.float32)
                table[self.rows[size].of(own_keys)] = values
                self.tables[name][kind, size] = table

    def surprisals(self, rows: dict, laid: dict) -> np.ndarray:
        """-log p of every character under one language."""
        out = laid["gram", ORDER][rows[ORDER, "gram"]]
        missing = np.flatnonzero(np.isnan(out))
        if not len(missing):
            return -out
        weight = np.zeros(len(missing), np.float32)
        where = missing
        for n in range(ORDER, 0, -1):  # back off while the gram is unseen
            weight = weight + (laid["context", n - 1][rows[n - 1, "context"][where]] if n > 1
                               else laid["context", 0][0])
            if n == 1:
                out[where] = weight - np.float32(math.log(ALPHABET))
                break
            value = laid["gram", n - 1][rows[n - 1, "gram"][where]]
            found = ~np.isnan(value)
            out[where[found]] = weight[found] + value[found]
            where, weight = where[~found], weight[~found]
            if not len(where):
                break
        return -out

    def sums(self, text: str) -> tuple[int, dict[str, tuple[float, float]]]:
        """Characters of this part, and per language the sum of surprisals and of their squares."""
        n, total = 0, {name: [0.0, 0.0] for name in self.tables}
        for block in self.letters.blocks(text):
            rows = {(ORDER, "gram"): self.rows[ORDER].of(grams(block, ORDER))}
            for k in range(1, ORDER):  # a context is the gram that ends one character before
                found = self.rows[k].of(grams(np.concatenate((block[:1], block)), k))
                rows[k, "gram"], rows[k, "context"] = found[1:], found[:-1]
            if self.parts > 1:
                own = np.flatnonzero(block[ORDER - 2:-1] % np.uint64(self.parts) == self.part)
                rows = {key: found[own] for key, found in rows.items()}
            n += len(rows[ORDER, "gram"])
            for name, laid in self.tables.items():
                values = self.surprisals(rows, laid).astype(np.float64)
                total[name][0] += float(values.sum())
                total[name][1] += float(values @ values)
        return n, {k: tuple(v) for k, v in total.items()}


_SCORED = "struct<lang_pred:string,score:double,entropy:double,variance:double,n_chars:bigint>"


def scored(df: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``df`` with struct(lang_pred, score, entropy, variance, n_chars), written out.

    ``score`` is the share of the best language when cross-entropies are compared over at most
    40 characters; 0 for ``und``. Null and empty texts are ``und``, and so is everything without
    a model. Rows are scored one by one, whatever their ids; a column named ``out`` is replaced.
    """
    df = df.drop(out)
    if not model.blocks:
        none = F.struct(F.lit(UNKNOWN), F.lit(0.0), F.lit(None), F.lit(None), F.lit(0))
        return df.withColumn(out, none.cast(_SCORED))
    sc = df.sparkSession.sparkContext
    if len(model.blocks) == 1:
        shared = sc.broadcast(model.arrays(model.blocks[0]))
        done = cut_lineage(df.withColumn(out, _decided(_sums(F.col(f"`{text}`"), shared))))
        shared.destroy()
        return done
    key, found = free_name(df, "row"), free_name(df, "found")
    rows = cut_lineage(df.withColumn(key, F.monotonically_increasing_id()))
    sums = []
    for block in model.blocks:
        shared = sc.broadcast(model.arrays(block))
        sums.append(cut_lineage(rows.select(key, _sums(F.col(f"`{text}`"), shared).alias(found))))
        shared.destroy()
    every = sums[0]
    for part in sums[1:]:
        every = every.unionByName(part)
    every = every.groupBy(key).agg(F.flatten(F.collect_list(found)).alias(found))
    done = rows.join(every, key).withColumn(out, _decided(F.col(found)))
    return cut_lineage(done.drop(key, found))


def judged(df: DataFrame, limits: dict, out: str = "language") -> DataFrame:
    """Scored rows with ``accepted`` in their struct; ``und`` is never accepted."""
    name, limit = free_name(df, "name"), free_name(df, "limit")
    kind = "struct<mean:double,chars:double,spread:double,most:double>"
    known = [(k, v) for k, v in limits.items() if k is not None]
    table = df.sparkSession.createDataFrame(known, f"{name} string, {limit} {kind}")
    usual = F.struct(*[F.lit(x) for x in limits[None]]).cast(kind)
    rows = df.join(F.broadcast(table), F.col(f"{out}.lang_pred") == F.col(name), "left")
    at, own = F.coalesce(F.col(limit), usual), F.col(out)
    allowed = F.greatest(F.lit(MARGIN), at["most"] * F.sqrt(
        at["spread"] + at["chars"] / F.nullif(own["n_chars"], F.lit(0)) + 1e-4))
    accepted = F.coalesce(own["entropy"] - at["mean"] <= allowed, F.lit(False))
    return rows.withColumn(out, own.withField("accepted", accepted)).drop(name, limit)


def identified(df: DataFrame, model: Model, own: Column | None = None, lang: str = "lang",
               text: str = "text", out: str = "language") -> DataFrame:
    """``df`` scored once and judged; the limits come from its rows where ``own`` (default: all)
    with a language. Struct as in ``scored``, with ``accepted``."""
    rows = scored(df, model, text, out)
    from_rows = rows if own is None else rows.where(own)
    return judged(rows, limits(from_rows, lang, out), out)


def _decided(sums: Column) -> Column:
    @F.arrow_udf(_SCORED)
    def decide(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in lean(parts):
            rows = [_decision(found) for found in part.to_pylist()]
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [()] * 5
            keys = ("lang_pred", "score", "entropy", "variance", "n_chars")
            yield struct_array({k: pa.array(list(c), t)
                                for k, c, t in zip(keys, columns, kinds, strict=True)})

    return decide(sums)


def _sums(text: Column, shared) -> Column:
    """Characters and sums of surprisals of each text under the languages of one block."""

    @F.arrow_udf("array<struct<lang:string,n:bigint,total:double,squares:double>>")
    def sums(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _block_sums(parts, shared)

    return sums(text)


def _block_sums(parts, shared):
    kept = shared.value
    if "scorer" not in kept:
        kept["scorer"] = Scorer(kept)
        del kept["arrays"]  # the scorer has its own
    scorer = kept["scorer"]
    item = pa.struct([("lang", pa.string()), ("n", pa.int64()), ("total", pa.float64()),
                      ("squares", pa.float64())])
    for part in lean(parts):
        rows = []
        for value in part:
            n, sums = scorer.sums(value.as_py() or "")
            rows.append([{"lang": k, "n": n, "total": a, "squares": b}
                         for k, (a, b) in sums.items()])
        yield pa.array(rows, pa.list_(item))


def _decision(found: list[dict]) -> tuple:
    sums: dict = {}
    for x in found:  # a language may come in parts
        n, total, squares = sums.get(x["lang"], (0, 0.0, 0.0))
        sums[x["lang"]] = n + x["n"], total + x["total"], squares + x["squares"]
    n = next(iter(sums.values()))[0] if sums else 0
    if not n:
        return UNKNOWN, 0.0, None, None, 0
    entropy = {name: total / n for name, (_, total, _) in sums.items()}
    best = min(entropy, key=lambda k: (entropy[k], k))
    shares = [math.exp(min(n, 40) * (entropy[best] - v)) for v in entropy.values()]
    variance = max(0.0, sums[best][2] / n - entropy[best] ** 2)
    return best, 1.0 / sum(shares), entropy[best], variance, n
