"""Byte-level BPE over a column of texts: encoding, decoding and prefix token counts.

A null text counts as empty. Repeated rows are handled row by row; other columns are kept.
Texts are read whole; working memory is one Arrow batch and bounded caches per worker. The
vocabulary is broadcast: its size is that of the file, which is a parameter of the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayprints.llm import bpe
from dayprints.llm.texts import in_slices, lean, struct_array


def load(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary of a rank file (.tiktoken) or of a byte-level tokenizer file (.json)."""
    read = bpe.read_json if path.endswith(".json") else bpe.read_ranks
    return spark.sparkContext.broadcast({"vocabulary": read(path)})


def _tool(shared: Broadcast, kind: type, *args):
    """The machine of this worker process: made once, kept with the broadcast value."""
    kept = shared.value
    name = (kind.__name__, *args)
    if name not in kept:
        kept[name] = kind(kept["vocabulary"], *args)
    return kept[name]


def encoded(text: Column, vocabulary: Broadcast, pattern: str) -> Column:
    """Token ids of each text, without special tokens; [] for null."""

    @F.arrow_udf("array<int>")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _tool(vocabulary, bpe.Encoder, pattern)
        for part in in_slices(parts):
            texts = (v.as_py() for v in part)
            yield pa.array(list(encoder.encode_all(texts)), pa.list_(pa.int32()))

    return encode(text)


def decoded(ids: Column, vocabulary: Broadcast) -> Column:
    """The text of each list of ids; bytes that are not UTF-8 become U+FFFD; null for null."""

    @F.arrow_udf("string")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _tool(vocabulary, bpe.Decoder)
        for part in lean(parts):
            yield pa.array([None if x is None else decoder.text(x) for x in part.to_pylist()],
                           pa.string())

    return decode(ids)


def round_trip(text: Column, vocabulary: Broadcast, pattern: str,
               with_ids: bool = False) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256, exact): digests of encoding and decoding.

    ``exact`` tells whether the streaming decoder gives the text again. ``with_ids`` adds ids.
    """
    ids_field = ",ids:array<int>" if with_ids else ""

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string,exact:boolean"
                 f"{ids_field}>")
    def digest(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _tool(vocabulary, bpe.Encoder, pattern)
        decoder = _tool(vocabulary, bpe.Decoder)
        written = encoder.written
        for part in in_slices(parts):
            rows, kept = [], []
            texts = (v.as_py() for v in part)
            for value, ids in zip(part, encoder.arrays_of_all(texts), strict=True):
                shown = ",".join(written[ids].tolist())
                back = decoder.text(ids)
                # without a replacement character the text's bytes are the decoded ones
                raw = (decoder.to_bytes(ids.tolist()) if "\ufffd" in back
                       else back.encode("utf-8"))
                rows.append((len(ids), hashlib.sha256(shown.encode()).hexdigest(),
                             hashlib.sha256(raw).hexdigest(), back == (value.as_py() or "")))
                if with_ids:
                    kept.append(ids)
            n, a, b, exact = zip(*rows, strict=True) if rows else ((), (), (), ())
            columns = {
                "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(a, pa.string()),
                "decoded_sha256": pa.array(b, pa.string()), "exact": pa.array(exact, pa.bool_())}
            if with_ids:
                ends = np.cumsum([0, *map(len, kept)], dtype=np.int32)
                flat = np.concatenate(kept) if kept else np.empty(0, np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield struct_array(columns)

    return digest(text)


def token_counts(text: Column, vocabulary: Broadcast, pattern: str) -> Column:
    """Tokens of each text, special strings in it counting as one token; 0 for null."""

    @F.arrow_udf("bigint")
    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _tool(vocabulary, bpe.PrefixCounter, pattern)
        for part in lean(parts):
            yield pa.array([counter.count(t.as_py() or "") for t in part], pa.int64())

    return count(text)


def with_stops(df: DataFrame, vocabulary: Broadcast, pattern: str, text: str = "text",
               out: str = "stops") -> DataFrame:
    """Add struct(ends, totals): the end of every piece and the exact tokens up to it.

    Stored once, they answer ``prefix_tokens`` for any prefix without encoding the text again.
    """

    @F.arrow_udf("struct<ends:array<int>,totals:array<int>>")
    def stops(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _tool(vocabulary, bpe.PrefixCounter, pattern)
        for part in lean(parts):
            found = [counter.stops(t or "") for t in part.to_pylist()]
            yield struct_array({"ends": pa.array([e for e, _ in found], pa.list_(pa.int32())),
                                "totals": pa.array([n for _, n in found], pa.list_(pa.int32()))})

    return df.withColumn(out, stops(F.col(text)))


def prefix_tokens(text: Column, stops: Column, size: Column, vocabulary: Broadcast,
                  pattern: str) -> Column:
    """Exact tokens of the first ``size`` characters (code points), from the stored stops."""

    @F.arrow_udf("bigint")
    def count(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        counter = _tool(vocabulary, bpe.PrefixCounter, pattern)
        for texts, stored, sizes in parts:
            yield pa.array([
                None if k is None else
                counter.prefix_count(t or "", (s["ends"], s["totals"]), min(k, len(t or "")))
                for t, s, k in zip(texts.to_pylist(), stored.to_pylist(), sizes.to_pylist(),
                                   strict=True)], pa.int64())

    return count(text, stops, size)


def truncated(text: Column, budget: int, vocabulary: Broadcast, pattern: str) -> Column:
    """Each text cut to at most ``budget`` tokens; a null text stays null."""

    @F.arrow_udf("string")
    def cut(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _tool(vocabulary, bpe.PrefixCounter, pattern)
        for part in lean(parts):
            yield pa.array([None if t is None else counter.truncate(t, budget)
                            for t in part.to_pylist()], pa.string())

    return cut(text)
