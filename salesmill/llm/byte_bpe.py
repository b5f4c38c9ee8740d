"""Byte-level BPE encoding and decoding by a lazily determinised finite-state transducer.

A sequence of tokens is what the merges give exactly when each adjacent pair of it is. So every prefix of the input has
one last token, found from the last tokens of shorter prefixes, and the encoder is a finite-state machine: a state is
the last token already emitted and the bytes after it whose cut is still open. A token is emitted as soon as every way
the input could go on agrees on it, which the longest token bounds. States and arcs are made when first met and kept in
bounded tables. The pretoken pattern cuts the text first; pretokens seen before are taken from one memo: pieces made of
them recur less, and remembering both halves what the memo can hold.

Decoding maps ids to bytes and passes them through an incremental UTF-8 state machine, so any chunking gives the same
text.

Null text counts as empty and gives no ids; ids unknown to the vocabulary raise; rows pass one to one.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, map_batches, texts

#: White space run of three or more, whose split depends on its length.
LONG_RUN = re.compile(r"\s\s\s")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Pieces:
    """Cuts text where the pretoken pattern always cuts: before a white-space run that follows something else."""

    def __init__(self, encode, memo: int = 400_000):
        """encode: from a piece to what is kept for it."""
        self.whole = Recent(encode, memo // 2)
        self.spaced = Recent(lambda piece: encode(" " + piece), memo)
        self.slow = regex.compile(r"\s*\S+|\s+")

    def __call__(self, text: str) -> Iterator:
        """What is kept for the pieces of `text`, in order."""
        if text[-1:].isspace() or LONG_RUN.search(text):
            yield from map(self.whole.__getitem__, self.slow.findall(text))
            return
        start = ""
        for line in text.split("\n"):
            head, *words = line.split(" ")
            yield self.whole[start + head]
            start = "\n"
            yield from map(self.spaced.__getitem__, words)


class Transducer:
    """Emits the tokens of byte strings; see the module's text."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 250_000, max_pairs: int = 500_000):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.prefixes = {token[:i] for token in ranks for i in range(1, len(token))}
        self.max_states, self.max_pairs = max_states, max_pairs
        self.pairs: dict[int, bool] = {}
        #: A trie of the tokens: arcs by node << 8 | byte, and the rank of the token that ends at a node.
        self.trie: dict[int, int] = {}
        self.token_at = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                to = self.trie.get(node << 8 | byte)
                if to is None:
                    to = self.trie[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                node = to
            self.token_at[node] = rank
        self.split: dict[bytes, tuple[bytes, bytes]] = {}
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple[bytes, bytes], int] = {}
        #: Of each state: the token before, the open bytes, and where the last token of each of their prefixes starts
        #: (None: no token to come can start there).
        self.open: list[tuple[bytes, bytes, list[int | None]]] = []
        self.arcs: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.missed: set[int] = set()
        self.ends: dict[int, tuple[int, ...]] = {}
        self.start = self._state(b"", b"", [0])

    def halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two tokens whose merge gives `token`: plain merging by the ranks below its own; (token, b"") for a byte."""
        known = self.split.get(token)
        if known is None:
            limit = self.ranks[token]
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 2:
                rank, i = min((self.ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank >= limit:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            # A string that its own merges never reach has no halves and is never emitted.
            known = (parts[0], parts[1]) if len(parts) == 2 else (token, b"")
            self.split[token] = known
        return known

    def reached(self, token: bytes) -> bool:
        """Whether merging the bytes of `token` gives it."""
        return len(token) == 1 or bool(self.halves(token)[1])

    def fits(self, before: int, token: int) -> bool:
        """Whether the merges leave these two adjacent tokens (ranks; -1: nothing before) as they are.

        They don't if a part at the end of the first and one at the start of the second, alive at the same time, merge
        before the later of the merges that use them up.
        """
        key = before << 32 | token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > self.max_pairs:
                self.pairs.clear()
            right = self.bytes_of[token]
            known = self.reached(right) and (before < 0 or self._apart(self.bytes_of[before], right))
            self.pairs[key] = known
        return known

    def _apart(self, left: bytes, right: bytes) -> bool:
        """Walk back through the merges of both sides, the latest first."""
        ranks, halves, none = self.ranks, self.halves, 1 << 60
        # Rank at which each side's outermost part was used up by a larger one.
        until_left = until_right = none
        while True:
            rank = ranks.get(left + right, none)
            # Equal ranks go from left to right: the left side's merge of that rank is to the left of this pair, the right's is not.
            if rank < until_left and rank <= until_right and rank < none:
                return False
            made_left, made_right = (ranks[x] if len(x) > 1 else -1 for x in (left, right))
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                until_left, left = made_left, halves(left)[1]
            else:
                until_right, right = made_right, halves(right)[0]

    def _state(self, before: bytes, pending: bytes, last: list[int | None]) -> int:
        key = (before, pending)
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.open)
            self.open.append((before, pending, last))
        return number

    def _arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        before, pending, last = self.open[state]
        pending += bytes((byte,))
        n = len(pending)
        last = [*last, None]
        ranks, fits = self.ranks, self.fits
        for s in range(max(0, n - self.longest), n):
            if last[s] is not None:
                token = pending[s:]
                if token in ranks and fits(ranks.get(pending[last[s] : s] if s else before, -1), ranks[token]):
                    last[n] = s
                    break
        emitted: tuple[int, ...] = ()
        if pending not in self.prefixes:  # else a token to come may start at the very beginning
            agreed = -1  # the last cut on the way to every place where a token to come may start
            for p in range(n, 0, -1):
                if last[p] is not None and (p == n or pending[p:] in self.prefixes):
                    agreed = p if agreed < 0 else agreed
                    while agreed != p:
                        if agreed > p:
                            agreed = last[agreed]
                        else:
                            p = last[p]
                    if not agreed:
                        break
            if agreed > 0:
                tokens, end = [], agreed
                while end:
                    tokens.append(pending[last[end] : end])
                    end = last[end]
                emitted = tuple([self.ranks[t] for t in reversed(tokens)])
                before, pending = tokens[0], pending[agreed:]
                last = [0] + [p - agreed if p is not None and p >= agreed else None for p in last[agreed + 1 :]]
        return self._state(before, pending, last), emitted

    def _end(self, state: int) -> tuple[int, ...]:
        _, pending, last = self.open[state]
        out, end = [], len(pending)
        while end:
            out.append(self.ranks[pending[last[end] : end]])
            end = last[end]
        return tuple(out[::-1])

    def _rest(self, state: int, rest: bytes) -> list[int]:
        """The tokens from `state` to the end without new states: longest tokens first, going back where none fits.

        A prefix has one valid last token, so a place from which the end was not reached need not be tried again.
        """
        before, pending, _ = self.open[state]
        data = pending + rest
        trie, token_at, pairs, fits = self.trie.get, self.token_at, self.pairs.get, self.fits
        size, at, last = len(data), 0, self.ranks.get(before, -1)
        out: list[int] = []
        back: list[tuple[int, int, list[tuple[int, int]]]] = []  # place, token before it, what is left to try there
        dead: set[int] = set()
        while at < size:
            tries, node, n = [], 0, at
            while n < size:
                node = trie(node << 8 | data[n])
                if node is None:
                    break
                n += 1
                if (token := token_at[node]) >= 0:
                    tries.append((n, token))
            while True:
                if tries:
                    n, token = tries.pop()
                    if n not in dead:
                        known = pairs(last << 32 | token)
                        if fits(last, token) if known is None else known:
                            break
                else:
                    dead.add(at)
                    at, last, tries = back.pop()
                    out.pop()
            back.append((at, last, tries))
            out.append(token)
            at, last = n, token
        return out

    def encode(self, raw: bytes) -> list[int]:
        if len(self.open) > self.max_states or len(self.missed) > 4 * self.max_states:
            self.reset()
        out: list[int] = []
        state, arcs, missed = self.start, self.arcs, self.missed
        for i, byte in enumerate(raw):
            key = state << 8 | byte
            arc = arcs.get(key)
            if arc is None:
                # An arc is made when it is wanted a second time: the ends of most rare words never are.
                if key not in missed and len(raw) - i <= self.longest:
                    missed.add(key)
                    return out + self._rest(state, raw[i:])
                arc = arcs[key] = self._arc(state, byte)
            state, emitted = arc
            if emitted:
                out += emitted
        ends = self.ends.get(state)
        if ends is None:
            ends = self.ends[state] = self._end(state)
        out += ends
        return out


class Utf8Stream:
    """Incremental UTF-8: `feed` gives the text that is complete so far, the state holds the bytes of an open character."""

    def __init__(self):
        self.open = b""

    @staticmethod
    def _needs(lead: int) -> int:
        return 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1

    def feed(self, chunk: bytes, end: bool = False) -> str:
        data = self.open + chunk
        cut = len(data)
        if not end:
            for back in range(1, min(3, len(data)) + 1):
                byte = data[-back]
                if byte & 0xC0 != 0x80:  # a lead byte or ASCII
                    if self._needs(byte) > back:
                        cut -= back
                    break
        self.open = data[cut:]
        return data[:cut].decode("utf-8", "replace")


#: Bounds of what a worker remembers; they change its speed and memory, never the ids.
MAX_STATES, MAX_PAIRS, MEMO_MATCHES = 100_000, 500_000, 250_000


class Codec:
    """Text to ids and back with a vocabulary of ranks and a pretoken pattern."""

    def __init__(self, path: str, pattern: str):
        self.pattern, self.ranks = pattern, read_ranks(path)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}

    @cached_property
    def machine(self) -> Transducer:
        return Transducer(self.ranks, MAX_STATES, MAX_PAIRS)

    @cached_property
    def find(self) -> Callable[[str], list[str]]:
        return regex.compile(self.pattern).findall

    @cached_property
    def ids_of(self) -> Callable[[str], bytes]:
        """Ids of a pretoken; made on first use, since a worker that only decodes needs no transducer."""
        encode = self.machine.encode
        return Recent(lambda match: array("i", encode(match.encode())).tobytes(), MEMO_MATCHES).__getitem__

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.ids_of, self.find(text))), np.int32)

    def decode(self, ids: np.ndarray, chunk: int = 65_536) -> Iterable[str]:
        """The text, chunk by chunk."""
        stream, of = Utf8Stream(), self.bytes_of.__getitem__
        for i in range(0, len(ids), chunk):
            yield stream.feed(b"".join(map(of, ids[i : i + chunk].tolist())))
        yield stream.feed(b"", end=True)


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker and vocabulary, so that states and memo live on between tasks."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def id_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int32), *arrays])))


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: one row per row of `docs`."""

    def build():
        encode = codec(path, pattern).encode
        return lambda batch: pa.RecordBatch.from_arrays(
            [batch.column(0), id_lists([encode(t) for t in texts(batch.column(1))])], names=["doc_id", "ids"]
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, build, "doc_id long, ids array<int>")


def lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The arrays of a list<int32> column, null as empty."""
    flat, offsets = column.values.to_numpy(), column.offsets.to_numpy()  # offsets of a slice point into the whole values
    return (flat[a:b] for a, b in zip(offsets, offsets[1:]))


def decoded(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, text: the decoded text of each row of ids."""

    def build():
        decode = codec(path, pattern).decode
        return lambda batch: pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(["".join(decode(ids)) for ids in lists(batch.column(1))], pa.string())],
            names=["doc_id", "ids", "text"],
        )

    return map_batches(coded.select("doc_id", "ids"), build, "doc_id long, ids array<int>, text string")
