"""Byte-level BPE: merge rules, an encoding transducer, prefix counts and a streaming decoder.

Two facts about BPE carry the module. A sequence of canonical tokens is the encoding of its
bytes exactly if every two neighbours are *compatible*, that is if encoding the two tokens'
bytes gives those two tokens again. And the encoding of a prefix is found from left to right:
its last token is the one token that ends there and is compatible with the last token of what
stands before it. The transducer (``Encoder``) and the prefix counts (``PrefixCounter``) are
both built on these facts; merges are replayed only to learn a token's own derivation.
"""

from __future__ import annotations

import base64
import gc
import json
import math
import re
import struct
import sys
from array import array
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import regex

INF = math.inf
NEVER = 1 << 62  # a rank beyond all
START = 0xFFFFFF
_RUNS = re.compile(rb"[\x00-\x7f]+|[\x80-\xff]+")


# ---------------------------------------------------------------- vocabularies

def read_ranks(path: str) -> dict:
    """A rank file: two neighbours join if their bytes together are a token, lowest rank first."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return {"ids": ranks, "pairs": None, "specials": {}, "whole": True}


def _printable_bytes() -> dict[str, int]:
    """The byte for each printable stand-in of a byte-level vocabulary file."""
    # fixed values of the file format: bytes that stand for themselves
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_json(path: str) -> dict:
    """A byte-level tokenizer file: two neighbours join if they are a listed pair, in list order."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte = _printable_bytes()

    def raw(shown: str) -> bytes:
        return bytes(byte[c] for c in shown)

    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in specials}
    listed = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
    pairs = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(listed)}
    return {"ids": ids, "pairs": pairs, "specials": specials, "whole": False}


class Merges:
    """Merge rules with each token's derivation, learnt when first asked for."""

    def __init__(self, vocabulary: dict, most_fits: int = 300_000):
        self.ids: dict[bytes, int] = vocabulary["ids"]
        self.most_fits = most_fits
        self.bytes_of = {i: t for t, i in self.ids.items()}
        pairs = vocabulary["pairs"]
        if pairs is None:
            ids = self.ids
            self.rank = lambda x, y: ids.get(x + y)
        else:
            self.rank = lambda x, y: pairs.get((x, y))
        self._split: dict[bytes, tuple | None] = {}
        self._right: dict[bytes, list] = {}
        self._left: dict[bytes, list] = {}
        self.known_fits: dict[int, bool] = {}
        self._by_bytes = pairs is None and all(bytes([i]) in self.ids for i in range(256))
        self._flat: list[tuple] = []  # of both sides: parts and ranks of edges, and their begins

    def replay(self, piece: bytes, down_to: int = 1) -> list[bytes]:
        """The parts of ``piece`` after merging, lowest rank first and leftmost on ties."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > down_to:
            ranked = [(r, i) for i in range(len(parts) - 1)
                      if (r := self.rank(parts[i], parts[i + 1])) is not None]
            if not ranked:
                break
            _, i = min(ranked)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def split(self, token: bytes) -> tuple | None:
        """(left, right, rank) of the token's last merge; () for a byte; None if merging never
        gives the token."""
        if token not in self._split:
            if len(token) == 1:
                found = () if token in self.ids else None
            else:
                parts = self.replay(token, down_to=2)
                joined = len(parts) == 2 and self.rank(*parts) is not None and token in self.ids
                found = (*parts, self.rank(*parts)) if joined else None
            self._split[token] = found
        return self._split[token]

    def _edge(self, token: bytes, side: int, memo: dict) -> list[tuple[bytes, float]]:
        """The parts that stand at one end of the token while it is formed, from its byte to
        itself, each with the rank of the merge that ends it."""
        if token not in memo:
            split = self.split(token)
            if not split:
                memo[token] = [(token, INF)]
            else:
                inner = self._edge(split[side], side, memo)
                memo[token] = [*inner[:-1], (inner[-1][0], split[2]), (token, INF)]
        return memo[token]

    def fits(self, a: int, b: int) -> bool:
        """Is b canonical, and does encoding the bytes of the tokens a, b give them again? At the
        start of a text (a is START) only the first is asked.

        Both derivations run side by side in rank order. They part company if, at some
        moment, the parts that meet at the border join before either joins on its own side;
        of equal ranks the left one goes first.
        """
        key = a << 24 | b
        known = self.known_fits.get(key)
        if known is None:
            if len(self.known_fits) > self.most_fits:  # a cache, not a table: it can be refilled
                self.known_fits.clear()
            known = self.known_fits[key] = self._derive(a, b)
        return known

    def _derive(self, a: int, b: int) -> bool:
        second = self.bytes_of[b]
        if self.split(second) is None:
            return False
        if a == START:
            return True
        left = self._edge(self.bytes_of[a], 1, self._right)
        right = self._edge(second, 0, self._left)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            rank = self.rank(x, y)
            if rank is not None and rank < x_ends and rank <= y_ends:
                return False
            if x_ends <= y_ends:
                if x_ends == INF:
                    return True
                i += 1
            else:
                j += 1


    def _tables(self) -> None:
        """Ranks of all pairs of tokens that join, in order of the pairs, and empty edges."""
        ids, joins = self.ids, []
        for token, number in ids.items():
            for k in range(1, len(token)):
                a, b = ids.get(token[:k]), ids.get(token[k:])
                if a is not None and b is not None:
                    joins.append((a << 24 | b, number))
        joins = np.array(joins, np.int64).reshape(-1, 2)
        self._joins, self._ranks = joins[np.argsort(joins[:, 0])].T.copy()
        room = max(ids.values()) + 1
        self._canonical = np.zeros(room, bool)
        self._flat = [(array("q"), array("q"), np.full(room, -1)) for _ in range(2)]

    def _edges(self, tokens: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The edges of all tokens asked for so far: parts, ranks that end them, and begins."""
        parts, ends, begin = self._flat[side]
        memo = self._right if side else self._left
        for number in np.unique(tokens[begin[tokens] < 0]).tolist():
            token, begin[number] = self.bytes_of[number], len(parts)
            self._canonical[number] = self.split(token) is not None
            for part, end in self._edge(token, side, memo):
                parts.append(self.ids[part])
                ends.append(NEVER if end == INF else end)
        return np.frombuffer(parts, np.int64), np.frombuffer(ends, np.int64), begin

    def fit(self, pairs: np.ndarray) -> np.ndarray:
        """``fits`` for many pairs a << 24 | b, whose derivations run side by side."""
        if not self._by_bytes:
            return np.array([self.fits(x >> 24, x & 0xFFFFFF) for x in pairs.tolist()], bool)
        if not self._flat:
            self._tables()
        a, b = pairs >> 24, pairs & 0xFFFFFF
        right, right_ends, right_begin = self._edges(b, 0)
        good = self._canonical[b]
        left, left_ends, left_begin = self._edges(a[a != START], 1)
        open_ = np.flatnonzero(good & (a != START))
        i, j = left_begin[a[open_]], right_begin[b[open_]]
        while len(open_):
            x_ends, y_ends = left_ends[i], right_ends[j]
            joined = left[i] << 24 | right[j]
            at = np.minimum(np.searchsorted(self._joins, joined), len(self._joins) - 1)
            rank = np.where(self._joins[at] == joined, self._ranks[at], NEVER)
            parted = (rank < x_ends) & (rank <= y_ends)
            good[open_[parted]] = False
            on_left = x_ends <= y_ends
            on = ~parted & ~(on_left & (x_ends == NEVER))
            open_, i, j = open_[on], (i + on_left)[on], (j + ~on_left)[on]
        return good


class Trie:
    """The tokens by their bytes, as numbers: node 0 is the root, -1 stands for no token."""

    def __init__(self, merges: Merges):
        self.below: list[dict[int, int]] = [{}]  # of a node: byte -> the node that extends it
        self.token, self.depth = [-1], [0]
        none: dict[int, int] = {}
        for token, number in merges.ids.items():
            node = 0
            for byte in token:
                if self.below[node] is none:
                    self.below[node] = {}
                following = self.below[node].get(byte)
                if following is None:
                    following = self.below[node][byte] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.below.append(none)
                node = following
            self.token[node] = number
        # the same for many nodes at once: edges by node and byte, in order
        edges = [(node << 8 | byte, to) for node, children in enumerate(self.below)
                 for byte, to in children.items()]
        self._edges, self._to = np.array(sorted(edges), np.int64).reshape(-1, 2).T.copy()
        self.tokens = np.array(self.token, np.int64)
        self.extended = np.fromiter(map(bool, self.below), bool, len(self.below))

    def children(self, nodes: np.ndarray, following: np.ndarray) -> np.ndarray:
        """The node that extends each node by a byte, or -1."""
        edges = nodes << 8 | following
        at = np.minimum(np.searchsorted(self._edges, edges), len(self._edges) - 1)
        return np.where(self._edges[at] == edges, self._to[at], -1)


def _uncollected(work, *args):
    """Does work that makes many objects and no cycles without searching them for cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        return work(*args)
    finally:
        if was:
            gc.enable()


# ---------------------------------------------------------------- encoding

class Encoder:
    """A transducer from bytes to tokens, determinised as far as the texts need it.

    A path of the nondeterministic machine is a trie node with the token that ends where the
    node's bytes begin. On a byte every path moves down the trie; where a canonical token ends
    that is compatible with the path's token, a path at the root begins. A deterministic state is
    the set of live paths; its move gives the one token that ends here. States and moves are made
    when first used and kept in a bounded table.

    A token is emitted once every live path's chain of tokens holds it: what is pending reaches
    back no further than tokens that may still change. The chains are compared every
    ``LOOKAHEAD`` bytes, and at the end of a piece.

    States and moves are forgotten when there are too many: there are at most ``MAX_STATES`` and
    ``MAX_MOVES``, and ``LEARN`` more of each during a step.
    """

    MAX_STATES = 60_000
    MAX_MOVES = 120_000
    LEARN = 50_000  # pieces that step through the machine side by side
    MAX_PIECES = 150_000
    TOGETHER = 1_000_000
    LOOKAHEAD = 64

    def __init__(self, vocabulary: dict, pattern: str):
        self.merges = Merges(vocabulary, most_fits=150_000)
        self.trie = Trie(self.merges)
        self.whole = vocabulary["whole"]
        self.pieces = regex.compile(pattern)
        self.size = {i: len(t) for i, t in self.merges.bytes_of.items()}
        self._sizes = np.zeros(max(self.size) + 1, np.int64)
        self._sizes[list(self.size)] = list(self.size.values())
        self.written = by_number({i: str(i) for i in self.size}, None)
        self._reset()
        self._new: dict[str, bytes] = {}  # pieces and their ids, packed
        self._old: dict[str, bytes] = {}

    def _reset(self) -> None:
        self._paths: list[bytes] = []  # packed, as tuples of numbers take thrice the room
        self._number: dict[bytes, int] = {}
        self._moves: dict[int, int] = {}  # state * 256 + byte -> state << 32 | token
        self._state(self._packed([START]))

    def _full(self) -> bool:
        return len(self._paths) > self.MAX_STATES or len(self._moves) > self.MAX_MOVES

    @staticmethod
    def _packed(paths: list[int]) -> bytes:
        return struct.pack(f"{len(paths)}q", *paths)

    @staticmethod
    def _unpacked(paths: bytes) -> tuple[int, ...]:
        return struct.unpack(f"{len(paths) // 8}q", paths)

    def _state(self, paths: bytes) -> int:
        """A state's number; a path is node << 24 | token, and a token of all ones stands for the
        start of the text."""
        number = self._number.get(paths)
        if number is None:
            number = self._number[paths] = len(self._paths)
            self._paths.append(paths)
        return number

    def _move(self, state: int, byte: int) -> int:
        token, below = self.trie.token, self.trie.below
        known, alive, done = self.merges.known_fits, [], -1
        for path in self._unpacked(self._paths[state]):
            child = below[path >> 24].get(byte)
            if child is None:
                continue
            last = path & 0xFFFFFF
            ended = token[child]
            if done < 0 and ended >= 0:
                good = known.get(last << 24 | ended)
                if good or good is None and self.merges.fits(last, ended):
                    done = ended
            if below[child]:
                alive.append(child << 24 | last)
        if done < 0:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        alive.append(done)  # a path at the root
        move = self._moves[state << 8 | byte] = self._state(self._packed(alive)) << 32 | done
        return move

    def _make(self, keys: list[int]) -> list[int]:
        """The moves of states on bytes, as ``_move`` makes them, many side by side."""
        ways = [self._paths[key >> 8] for key in keys]
        lengths = np.fromiter(map(len, ways), np.int64, len(ways)) >> 3
        row = np.repeat(np.arange(len(keys)), lengths)
        paths = np.frombuffer(b"".join(ways), np.int64)
        child = self.trie.children(paths >> 24, np.array(keys, np.int64)[row] & 255)
        live = child >= 0
        row, child, last = row[live], child[live], paths[live] & 0xFFFFFF
        done = np.full(len(keys), -1, np.int64)
        open_ = np.flatnonzero(self.trie.tokens[child] >= 0)
        while len(open_):  # the longest token of each row that is still open
            first = np.ones(len(open_), bool)
            first[1:] = row[open_[1:]] != row[open_[:-1]]
            tried = open_[first]
            ended = self.trie.tokens[child[tried]]
            pairs, place = np.unique(last[tried] << 24 | ended, return_inverse=True)
            good = self.merges.fit(pairs)[place]
            done[row[tried[good]]] = ended[good]
            open_ = open_[~first]
            open_ = open_[done[row[open_]] < 0]
        if done.min() < 0:
            raise ValueError(f"the vocabulary has no token for byte {keys[done.argmin()] & 255}")
        on = self.trie.extended[child]
        row, child, last = row[on], child[on], last[on]
        ends = np.cumsum(np.bincount(row, minlength=len(keys)) + 1)
        alive = np.empty(ends[-1], np.int64)
        alive[np.arange(len(row)) + row] = child << 24 | last
        alive[ends - 1] = done  # a path at the root
        packed, begin, moves = alive.tobytes(), 0, []
        for key, end, token in zip(keys, (8 * ends).tolist(), done.tolist(), strict=True):
            move = self._moves[key] = self._state(packed[begin:end]) << 32 | token
            moves.append(move)
            begin = end
        return moves

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Token ids of one piece, read once from left to right."""
        if self.whole and (known := self.merges.ids.get(piece)) is not None:
            return [known]
        state = 0
        out: list[int] = []
        ends: list[int] = []  # the token that ends at each pending byte
        for byte in piece:
            move = self._moves.get(state << 8 | byte)
            if move is None:
                move = self._move(state, byte)
                if self._full():
                    paths = self._paths[move >> 32]
                    self._reset()
                    move = self._state(paths) << 32 | move & 0xFFFFFFFF
            state = move >> 32
            ends.append(move & 0xFFFFFFFF)
            if len(ends) >= self.LOOKAHEAD:
                out += self._emit(ends, self._unpacked(self._paths[state]))
        return out + self._chain(ends, len(ends))

    def _chain(self, ends: list[int], at: int) -> list[int]:
        """The pending tokens up to a place."""
        size, out = self.size, []
        while at > 0:
            token = ends[at - 1]
            out.append(token)
            at -= size[token]
        out.reverse()
        return out

    def _emit(self, ends: list[int], paths: tuple[int, ...]) -> list[int]:
        """Takes from the pending bytes the tokens that the chains of all live paths share."""
        depth = self.trie.depth
        places = {len(ends) - depth[p >> 24] for p in paths}
        while len(places) > 1:  # step the furthest one back until all meet
            last = max(places)
            places.remove(last)
            places.add(last - self.size[ends[last - 1]])
        (agreed,) = places
        out = self._chain(ends, agreed)
        del ends[:agreed]
        return out

    def _learn(self, raws: list[bytes]) -> list[bytes]:
        """Packed token ids of some short pieces, which step through the machine side by side, so that
        every move is looked up once for all pieces that make it."""
        lengths = np.fromiter(map(len, raws), np.int64, len(raws))
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(raws), np.uint8)
        starts = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        ends = np.zeros((len(raws), int(lengths[0])), np.int32)
        state = np.zeros(len(raws), np.int64)
        for k in range(ends.shape[1]):
            n = int(np.searchsorted(-lengths, -k, "left"))  # pieces longer than k
            if self._full():
                live, place = np.unique(state[:n], return_inverse=True)
                paths = [self._paths[x] for x in live.tolist()]
                self._reset()
                state[:n] = np.array([self._state(p) for p in paths], np.int64)[place]
            moves = self._moves
            keys, place = np.unique(state[:n] << 8 | data[starts[:n] + k], return_inverse=True)
            made = list(map(moves.get, keys := keys.tolist()))
            fresh = [i for i, move in enumerate(made) if move is None]
            if fresh:
                for i, move in zip(fresh, self._make([keys[i] for i in fresh]), strict=True):
                    made[i] = move
            made = np.array(made, np.int64)[place]
            state[:n] = made >> 32
            ends[:n, k] = made & 0xFFFFFFFF
        if self._full():
            self._reset()
        columns, at, row = [], lengths, np.arange(len(raws))
        while at.any():  # chains of tokens from the ends of the pieces
            token = np.where(at > 0, ends[row, at - 1], np.int32(-1))
            columns.append(token)
            at = at - np.where(at > 0, self._sizes[token], 0)
        matrix = np.stack(columns[::-1], axis=1)
        real = matrix >= 0
        flat, bounds = matrix[real].tobytes(), (4 * np.cumsum(real.sum(axis=1))).tolist()
        found: list = [None] * len(raws)
        for i, a, b in zip(order.tolist(), [0, *bounds], bounds):
            found[i] = flat[a:b]
        return found

    def arrays(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of texts. Pieces seen lately are remembered, in two generations."""
        found = [self.pieces.findall(t) for t in texts]
        bounds = np.cumsum([0, *map(len, found)]).tolist()
        pieces = list(chain.from_iterable(found))
        del found
        if len(self._new) > self.MAX_PIECES:
            self._old, self._new = self._new, {}
        known, old, ids = self._new, self._old, self.merges.ids
        out = list(map(known.get, pieces))
        unknown = [i for i, packed in enumerate(out) if packed is None]
        fresh, raws, long = [], [], []
        for piece in set(map(pieces.__getitem__, unknown)):
            packed = old.get(piece)
            if packed is not None:
                known[piece] = packed
                continue
            raw = piece.encode("utf-8")
            if self.whole and raw in ids:
                known[piece] = ids[raw].to_bytes(4, sys.byteorder)
            elif len(raw) > self.LOOKAHEAD:
                known[piece] = np.array(self.encode_bytes(raw), np.int32).tobytes()
                long.append(piece)
            else:
                fresh.append(piece)
                raws.append(raw)
        for at in range(0, len(fresh), self.LEARN):
            part = slice(at, at + self.LEARN)
            known.update(zip(fresh[part], self._learn(raws[part]), strict=True))
        for i in unknown:
            out[i] = known[pieces[i]]
        for piece in long:
            del known[piece]
        return [np.frombuffer(b"".join(out[a:b]), np.int32) for a, b in zip(bounds, bounds[1:])]

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        return [ids.tolist() for ids in self.arrays(texts)]

    def arrays_of_all(self, texts) -> Iterator[np.ndarray]:
        """Token ids of each text (None: empty), a few megabytes of text at a time."""
        waiting, size = [], 0
        for text in texts:
            waiting.append(text or "")
            size += len(waiting[-1])
            if size >= self.TOGETHER:
                yield from _uncollected(self.arrays, waiting)
                waiting, size = [], 0
        yield from _uncollected(self.arrays, waiting)

    def encode_all(self, texts) -> Iterator[list[int]]:
        return (ids.tolist() for ids in self.arrays_of_all(texts))

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0]


# ---------------------------------------------------------------- decoding

class Utf8Machine:
    """Bytes to text, a chunk at a time. The state is the code point so far, how many bytes it
    still needs, and the range its next byte must lie in; a byte that does not fit gives U+FFFD
    and is read again as a first byte."""

    def __init__(self):
        self.need, self.low, self.high, self.value = 0, 0x80, 0xBF, 0

    @property
    def at_border(self) -> bool:
        return self.need == 0

    def feed(self, chunk: bytes) -> str:
        out = []
        for run in _RUNS.finditer(chunk):
            part = run.group()
            if part[0] < 0x80 and not self.need:
                out.append(part.decode("ascii"))
            else:
                self._read(part, out)
        return "".join(out)

    def _read(self, part: bytes, out: list[str]) -> None:
        for byte in part:
            if self.need:
                if self.low <= byte <= self.high:
                    self.value = self.value << 6 | byte & 0x3F
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.value))
                    continue
                out.append("\ufffd")
                self.need = 0
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                self.need = 1 if byte < 0xE0 else 2 if byte < 0xF0 else 3
                self.value = byte & (0x3F >> self.need)
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            else:
                out.append("\ufffd")

    def finish(self) -> str:
        """What remains of an unfinished code point."""
        left, self.need = self.need, 0
        self.low, self.high = 0x80, 0xBF
        return "\ufffd" if left else ""


def by_number(values: dict, hole) -> np.ndarray:
    """Values by their keys, small whole numbers; ``hole`` where there is no key."""
    out = np.empty(max(values) + 1, object)
    out.fill(hole)
    for i, value in values.items():
        out[i] = value
    return out


class Decoder:
    """Ids to bytes, or to text as the ids arrive. Unknown ids raise."""

    def __init__(self, vocabulary: dict):
        self.bytes_of = {i: t for t, i in vocabulary["ids"].items()}
        self.bytes_of |= {i: s.encode("utf-8") for s, i in vocabulary["specials"].items()}
        # the text of tokens that begin and end at borders of code points: the machine's moves
        # from its border state back to it
        self.whole: dict[int, str | None] = {}
        for i, raw in self.bytes_of.items():
            machine = Utf8Machine()
            shown = machine.feed(raw)
            self.whole[i] = shown if machine.at_border and "\ufffd" not in shown else None
        self._whole = by_number(self.whole, ())
        self._cut = np.array([not isinstance(x, str) for x in self._whole], bool)

    def to_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def stream(self, ids) -> Iterator[str]:
        """Text for each id as soon as its code points are complete."""
        machine = Utf8Machine()
        for i in ids:
            shown = self.whole[i] if machine.at_border else None
            yield machine.feed(self.bytes_of[i]) if shown is None else shown
        yield machine.finish()

    def text(self, ids) -> str:
        """The decoded text. Only tokens that begin or end inside a code point go through the
        machine, with those behind them until it is at a border again."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and ids.min() < 0:
            raise KeyError(int(ids.min()))
        parts = self._whole[ids].tolist()
        cut = np.flatnonzero(self._cut[ids]).tolist()
        if cut:
            ids = ids.tolist()
        for at in cut:
            if parts[at] is not None:
                if isinstance(parts[at], str):
                    continue  # read with those before it
                raise KeyError(ids[at])
            machine, end, shown = Utf8Machine(), at, []
            while end < len(ids) and (end == at or not machine.at_border):
                shown.append(machine.feed(self.bytes_of[ids[end]]))
                parts[end] = ""
                end += 1
            if end == len(ids):
                shown.append(machine.finish())
            parts[at] = "".join(shown)
        return "".join(parts)


# ---------------------------------------------------------------- counting

class PrefixCounter:
    """Exact token counts of every prefix of a text.

    Inside a piece, ``count[e] = count[s] + 1`` for the one token (s, e) that is compatible with
    the last token of the prefix that ends at s. The tokens that end at each place are found by
    one pass of an Aho-Corasick automaton. Across pieces counts add up.
    """

    MAX_PIECES = 200_000
    MAX_PIECE_BYTES = 64

    def __init__(self, vocabulary: dict, pattern: str):
        self.merges = Merges(vocabulary)
        self.whole = vocabulary["whole"]
        self.pieces = regex.compile(pattern)
        self.endings = ahocorasick.Automaton()
        for token, number in self.merges.ids.items():
            self.endings.add_word(token.decode("latin-1"), (len(token), number))
        self.endings.make_automaton()
        contents = sorted(vocabulary["specials"], key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, contents))) if contents else None
        self._new: dict[str, int] = {}
        self._old: dict[str, int] = {}

    def piece_counts(self, piece: bytes) -> list[int]:
        """Tokens of piece[:k] for k = 0 .. len(piece)."""
        fits, known = self.merges.fits, self.merges.known_fits.get
        count = [0] + [-1] * len(piece)
        last = [START] * (len(piece) + 1)
        for end, (size, token) in self.endings.iter(piece.decode("latin-1")):
            end += 1
            if count[end] < 0:
                before = last[end - size]
                good = known(before << 24 | token)
                if good or good is None and fits(before, token):
                    count[end], last[end] = count[end - size] + 1, token
        if self.whole:
            for k in range(1, len(piece) + 1):
                if piece[:k] in self.merges.ids:
                    count[k] = 1
        return count

    def piece_count(self, piece: str) -> int:
        """Tokens of a piece; pieces seen lately are remembered, in two generations."""
        known = self._new.get(piece)
        if known is None:
            known = self._old.get(piece)
            if known is None:
                known = self.piece_counts(piece.encode("utf-8"))[-1]
            if len(piece) <= self.MAX_PIECE_BYTES:
                if len(self._new) >= self.MAX_PIECES:
                    self._old, self._new = self._new, {}
                self._new[piece] = known
        return known

    def _segments(self, text: str):
        """(start, text, is special) of the parts that special strings cut a text into."""
        at = 0
        for match in self.special.finditer(text) if self.special else ():
            if match.start() > at:
                yield at, text[at:match.start()], False
            yield match.start(), match.group(), True
            at = match.end()
        if at < len(text):
            yield at, text[at:], False

    def count(self, text: str) -> int:
        total, get, learn = 0, self._new.get, self.piece_count
        for _, part, special in self._segments(text):
            if special:
                total += 1
                continue
            for piece in self.pieces.findall(part):
                known = get(piece)
                if known is None:
                    known = learn(piece)
                    get = self._new.get
                total += known
        return total

    def stops(self, text: str) -> tuple[list[int], list[int]]:
        """Ends of the pieces, and the tokens up to each."""
        ends, totals, total = [], [], 0
        for start, part, special in self._segments(text):
            matches = [(len(part), 1)] if special else [
                (m.end(), self.piece_count(m.group())) for m in self.pieces.finditer(part)]
            for end, n in matches:
                total += n
                ends.append(start + end)
                totals.append(total)
        return ends, totals

    def prefix_count(self, text: str, stops: tuple[list[int], list[int]], size: int) -> int:
        """Tokens of text[:size], from the stored stops: only the pieces that the cut may change
        are looked at again, which are the cut one and, with white space, the one before it."""
        if size <= 0:
            return 0
        ends, totals = stops
        low, high = 0, len(ends)
        while low < high:  # the first piece that ends at the cut or behind it
            middle = (low + high) // 2
            low, high = (middle + 1, high) if ends[middle] < size else (low, middle)
        cut_special = self.special and any(
            m.start() < size < m.end() for m in self.special.finditer(
                text, max(0, size - 256), min(len(text), size + 256)))
        back = low
        while back > 0 and (back > low - 2 or text[ends[back - 1] - 1].isspace() or cut_special
                            and back > low - 4):
            back -= 1
        start = ends[back - 1] if back else 0
        return (totals[back - 1] if back else 0) + self.count(text[start:size])

    def truncate(self, text: str, budget: int) -> str:
        """The longest prefix with at most ``budget`` tokens that ends in the piece after the last
        stop within the budget. One pass over that piece gives its candidates; each is verified,
        because a cut can change how white space and contractions are split."""
        stops = self.stops(text)
        ends, totals = stops
        k = sum(1 for n in totals if n <= budget)
        kept, base = (ends[k - 1], totals[k - 1]) if k else (0, 0)
        if budget < 0 or k == len(ends):
            return text[:kept]
        piece = text[kept:ends[k]]
        counts, at, good = self.piece_counts(piece.encode("utf-8")), 0, []
        for size, char in enumerate(piece[:-1], start=1):
            at += len(char.encode("utf-8"))
            if base + counts[at] <= budget:
                good.append(kept + size)
        for size in reversed(good):
            if self.prefix_count(text, stops, size) <= budget:
                return text[:size]
        return text[:kept]
