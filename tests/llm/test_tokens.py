"""Encoding, decoding and counting against the libraries that define them."""
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayprints.llm import bpe, tokens
from tests.llm.conftest import EDGE

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
PIECES = st.sampled_from(["a", "b", "the", " the", "  ", "\n", "'ll", "'", "é", "中", "1", "12",
                          "<|endoftext|>", "<|end", "_", "!!", "\u2003", "\x1c", "ing", "A"])
TEXT = st.one_of(st.text(max_size=60), st.lists(PIECES, max_size=30).map("".join))


VOCABULARY = bpe.read_ranks(RANKS)
ENCODER = bpe.Encoder(VOCABULARY, P.PATTERN)
COUNTER = bpe.PrefixCounter(bpe.read_json(JSON), P.PATTERN)
TOKENIZER = Tokenizer.from_file(JSON)


def tokens_of(text):
    return len(TOKENIZER.encode(text, add_special_tokens=False).ids)


LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=VOCABULARY["ids"],
                            special_tokens={})


@settings(max_examples=400, deadline=None)
@given(text=TEXT)
def test_encoding_is_the_librarys_and_decodes(text):
    ids = ENCODER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    decoder = bpe.Decoder(VOCABULARY)
    assert decoder.text(ids) == text == "".join(decoder.stream(ids))


def test_small_state_tables_change_nothing():
    small = bpe.Encoder(VOCABULARY, P.PATTERN)
    small.MAX_STATES, small.MAX_PIECES = 5, 2
    text = "unbelievable antidisestablishment " * 5 + "z" * 300
    assert small.encode(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(raw=st.binary(max_size=40), cut=st.integers(0, 40))
def test_stream_of_any_bytes_decodes_like_the_codec(raw, cut):
    machine = bpe.Utf8Machine()
    got = machine.feed(raw[:cut]) + machine.feed(raw[cut:]) + machine.finish()
    assert got == raw.decode("utf-8", "replace")


@settings(max_examples=150, deadline=None)
@given(text=TEXT)
def test_every_prefix_has_its_exact_count(text):
    assert COUNTER.count(text) == tokens_of(text)
    stops = COUNTER.stops(text)
    for size in range(len(text) + 1):
        assert COUNTER.prefix_count(text, stops, size) == tokens_of(text[:size])


@settings(max_examples=80, deadline=None)
@given(text=TEXT, budget=st.integers(0, 12))
def test_truncation_keeps_the_budget(text, budget):
    cut = COUNTER.truncate(text, budget)
    assert text.startswith(cut) and tokens_of(cut) <= budget
    if tokens_of(text) <= budget:
        assert cut == text


def test_columns_over_edge_cases(spark, docs):
    vocabulary = tokens.load(spark, RANKS)
    df = docs(EDGE).select("*", tokens.round_trip(F.col("text"), vocabulary, P.PATTERN).alias("c"),
                           tokens.encoded(F.col("text"), vocabulary, P.PATTERN).alias("ids"))
    rows = df.withColumn("back", tokens.decoded(F.col("ids"), vocabulary)).collect()
    assert len(rows) == len(EDGE)
    for row in rows:
        text = row["text"] or ""
        ids = LIBRARY.encode_ordinary(text)
        assert row["ids"] == ids and row["back"] == text and row["c"]["exact"]
        assert row["c"]["n_tokens"] == len(ids)
        assert row["c"]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["c"]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    empty = docs([]).select(tokens.round_trip(F.col("text"), vocabulary, P.PATTERN).alias("c"))
    assert empty.collect() == []


def test_counts_and_stored_stops(spark, docs):
    vocabulary = tokens.load(spark, JSON)
    rows = [*EDGE, (9, "a <|endoftext|> b")]
    df = tokens.with_stops(docs(rows), vocabulary, P.PATTERN)
    df = df.select("text", tokens.token_counts(F.col("text"), vocabulary, P.PATTERN).alias("k"),
                   tokens.prefix_tokens(F.col("text"), F.col("stops"), F.lit(7), vocabulary,
                                        P.PATTERN).alias("p"),
                   tokens.truncated(F.col("text"), 3, vocabulary, P.PATTERN).alias("cut"))
    for row in df.collect():
        text = row["text"] or ""
        assert row["k"] == tokens_of(text) and row["p"] == tokens_of(text[:7])
        assert (row["cut"] is None) == (row["text"] is None)
        assert tokens_of(row["cut"] or "") <= 3


def test_text_of_any_ids_equals_the_stream_and_the_decoded_bytes():
    decoder, chance = bpe.Decoder(VOCABULARY), random.Random(5)
    ids = sorted(decoder.bytes_of)
    for _ in range(500):
        some = [chance.choice(ids[:300] if chance.random() < 0.6 else ids)
                for _ in range(chance.randrange(30))]
        shown = decoder.to_bytes(some).decode("utf-8", "replace")
        assert decoder.text(some) == "".join(decoder.stream(some)) == shown


def test_small_caches_change_no_ids():
    small = bpe.Encoder(VOCABULARY, P.PATTERN)
    small.MAX_PIECES, small.MAX_STATES = 20, 200
    library = tiktoken.Encoding("test", pat_str=P.PATTERN, special_tokens={},
                                mergeable_ranks=VOCABULARY["ids"])
    chance = random.Random(6)
    for _ in range(100):
        texts = ["".join(chance.choice("abc dé 漢字😀1\n'") for _ in range(chance.randrange(90)))
                 for _ in range(5)] + ["x" * chance.randrange(200), ""]
        assert small.encode_many(texts) == [library.encode_ordinary(t) for t in texts]


def test_states_and_moves_stay_bounded_on_random_letters():
    small = bpe.Encoder(VOCABULARY, P.PATTERN)
    small.MAX_STATES, small.MAX_MOVES, small.LEARN, small.TOGETHER = 2_000, 3_000, 500, 20_000
    rnd = random.Random(6)
    texts = [" ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé中")
                              for _ in range(rnd.choice([3, 9, 20, 300])))
                      for _ in range(40)) for _ in range(60)]
    most = [0, 0]

    def watched(step):
        def move(*args):
            out = step(*args)
            most[:] = max(most[0], len(small._paths)), max(most[1], len(small._moves))
            return out
        return move

    small._move = watched(small._move)
    assert list(small.encode_all(texts)) == [ENCODER.encode(t) for t in texts]
    assert most[0] <= small.MAX_STATES + 2 * small.LEARN + 2
    assert most[1] <= small.MAX_MOVES + 2 * small.LEARN + 2


def test_pairs_fit_side_by_side_as_one_by_one():
    chance = random.Random(7)
    one, many = bpe.Merges(VOCABULARY), bpe.Merges(VOCABULARY)
    ids = sorted(one.bytes_of)
    pairs = [(chance.choice([bpe.START, *ids[:3000]]), chance.choice(ids[:3000]))
             for _ in range(4000)]
    pairs += [(chance.choice(ids), chance.choice(ids)) for _ in range(4000)]
    for token in chance.sample(list(one.ids), 2000):  # halves of a token do not fit
        k = chance.randrange(1, len(token)) if len(token) > 1 else 0
        if token[:k] in one.ids and token[k:] in one.ids:
            pairs.append((one.ids[token[:k]], one.ids[token[k:]]))
    for at in (0, 3000, 6000):
        part = pairs[at:at + 3000] if at < 6000 else pairs[6000:]
        got = many.fit(np.array([a << 24 | b for a, b in part], np.int64))
        assert got.tolist() == [one.fits(a, b) for a, b in part]
    assert not many.known_fits


def test_new_words_make_no_moves_one_by_one():
    chance = random.Random(8)
    texts = [" ".join("".join(chance.choice("abcdefghijklmnopqrstuvwxyzéñ")
                              for _ in range(chance.randrange(1, 14))) for _ in range(300))
             for _ in range(20)]
    encoder = bpe.Encoder(VOCABULARY, P.PATTERN)
    encoder._move = encoder.merges._derive = None
    assert list(encoder.encode_all(texts)) == [LIBRARY.encode_ordinary(t) for t in texts]
    assert encoder.merges.known_fits == {}


def test_tables_of_new_words_take_little_room():
    chance = random.Random(9)
    texts = [" ".join("".join(chance.choice("abcdefghijklmnopqrstuvwxyz")
                              for _ in range(chance.randrange(3, 14))) for _ in range(500))
             for _ in range(500)]
    encoder = bpe.Encoder(VOCABULARY, P.PATTERN)
    most = []
    made = encoder._make
    encoder._make = lambda keys: (made(keys), most.append(len(encoder._moves)))[0]
    for at in range(0, 500, 50):
        list(encoder.encode_all(texts[at:at + 50]))
    assert 0 < max(most) <= 180_000 and not encoder.merges.known_fits


def test_unknown_ids_raise():
    decoder = bpe.Decoder({"ids": {b"a": 0, b"b": 2}, "specials": {}})
    assert decoder.text([0, 2]) == "ab"
    for ids in ([0, 1], [3], [-1]):
        with pytest.raises((KeyError, IndexError)):
            decoder.text(ids)
