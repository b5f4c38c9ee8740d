"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as a doubly linked list of symbols. A heap holds the ranks of adjacent pairs; the lowest (leftmost at
ties) is popped and merged until no pair is left. The count is the initial symbols less the merges: no identifier is
emitted. Everything before the merges (special strings, NFC, lower case, the split, byte symbols) follows the
vocabulary file. Counts of chunks and words are memoised in bounded tables.

Null text counts as empty (no tokens). Text of any length is counted whole; rows pass one to one.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, map_batches, texts

#: Unicode White_Space, as the library's \s.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

#: Split by str.split() although no white space.
CONTROLS = regex.compile("[\\x1c-\\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Counter:
    """Counts tokens as the library of a word-end BPE file (.json) does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        ids = model["vocab"]
        self.ids = ids
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        self.symbols = byte_symbols()
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split.replace("\\s", SPACE))
        self.chunks = regex.compile(f"[^{SPACE}]+")
        self.of_word = Recent(self._word)
        self.of_chunk = Recent(self._chunk)

    def _word(self, word: str) -> int:
        raw = word.encode()
        seq = [self.ids[self.symbols[b]] for b in raw[:-1]] + [self.ids[self.symbols[raw[-1]] + self.end]]
        n = len(seq)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        merges = self.merges
        heap = [(*m, i, seq[i], seq[i + 1]) for i in range(n - 1) if (m := merges.get((seq[i], seq[i + 1])))]
        heapq.heapify(heap)
        count = n
        while heap:
            rank, new, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or seq[i] != a or seq[j] != b:  # one of the two is gone
                continue
            seq[i], seq[j] = new, -1
            after[i] = k = after[j]
            after[j] = -1
            count -= 1
            if k >= 0:
                before[k] = i
                if m := merges.get((new, seq[k])):
                    heapq.heappush(heap, (*m, i, new, seq[k]))
            h = before[i]
            if h >= 0 and (m := merges.get((seq[h], new))):
                heapq.heappush(heap, (*m, h, seq[h], new))
        return count

    def _plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # Character by character, as the library: a word's last sigma gets no form of its own.
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        of_word = self.of_word
        return sum(of_word[w] for w in self.split.findall(text))

    def _chunk(self, chunk: str) -> int:
        if self.special is None or "<|" not in chunk:
            return self._plain(chunk)
        specials = len(self.special.findall(chunk))
        return specials + sum(self._plain(part) for part in self.special.split(chunk))

    def count(self, text: str) -> int:
        # White space is dropped and nothing spans it, so chunks between blanks count alone.
        chunks = self.chunks.findall(text) if CONTROLS.search(text) else text.split()
        return sum(map(self.of_chunk.__getitem__, chunks))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per Python worker and file, so that the memo lives on between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of `docs`."""

    def build():
        count = counter(path).count

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([count(t) for t in texts(batch.column(2))], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

        return one

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text_col).alias("text"),
    )
    return map_batches(rows, build, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
