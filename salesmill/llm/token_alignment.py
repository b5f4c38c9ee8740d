"""Alignment of two tokenizers over the same text, by windows between verified anchors.

Both tokenizers read the whole text, A by its pretoken pattern. Byte offsets where a token of each ends are shared ends.
A shared end before a token that both mark with a space is an anchor; anchors split the document into windows of token
ids. What a window aligns to, and whether its bytes agree, depends on its ids alone, so both are memoised by its ids in a
bounded table: only new windows are aligned token by token, those of a batch together. A's bytes are compared with space+text, so windows that agree
verify the shared ends and B as a whole.

A document's distinct id pairs are staged; the number of documents that hold a pair is one combined count. Pairs found
in more than one in HOT_SHARE of all (document, pair) rows, of which there are fewer than HOT_SHARE, are broadcast and
looked up where the documents lie; one join looks up the others, so no key of it is hot.

Defined cases: null or empty texts, and those whose bytes a tokenizer changes, have no tokens: zeros and an empty
string. Repeated rows and ids are documents of their own; null ids are kept. An empty table gives no rows. Other
columns are ignored, so their names may clash.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, staged, texts
from .token_counts import byte_symbols

#: The character pieces use for a space.
SPACE_MARK = "▁"
#: What follows an id in the text of the groups: another of its side, the other side, the next group.
SEPARATORS = ",|;"
#: A pair with more than one in HOT_SHARE of all rows is hot.
HOT_SHARE = 100_000
#: Bound of the windows a worker remembers (twice, while the older half goes); it changes its speed and memory only.
MEMO_WINDOWS = 300_000
#: Windows of more tokens than this are not remembered.
MEMO_TOKENS = 64


#: Added to an id of B where it stands beside ids of A.
OF_B = 1 << 24
NONE = np.zeros(0, np.int64)


class Vocabulary:
    """Bytes of each id, their number, and whether they begin with a space."""

    def __init__(self, raw: list[bytes]):
        self.raw = raw
        self.length = np.array([len(r) for r in raw], np.int64)
        self.marked = np.array([r[:1] == b" " for r in raw])


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file (.json) whose ids follow the order of its merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte = {s: b for b, s in enumerate(byte_symbols())}
    ids = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in byte for c in token)}
    merged = [ids[b"".join(bytes(byte[c] for c in part) for part in (m.split(" ") if isinstance(m, str) else m))] for m in spec["model"]["merges"]]
    if spec.get("normalizer") or merged != sorted(merged):
        raise ValueError("a byte-level vocabulary without a normalizer, in the order of its merges, is needed")
    return ids


class Aligner:
    """Encodes with a byte-level BPE file (A) and a sentencepiece file (B) and aligns the two."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        import sentencepiece
        import tiktoken

        ids = read_vocabulary(path_a)
        # No special tokens: their strings in a text are plain text.
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ids, special_tokens={})
        raw = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            raw[i] = token
        self.of_a = Vocabulary(raw)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.vocab_size())]
        self.of_b = Vocabulary(
            [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in pieces]
        )
        # Every id as it is written before each separator.
        self.names = [f"{i}{separator}" for i in range(max(len(raw), len(pieces))) for separator in SEPARATORS]
        self.name_length = np.array([len(n) for n in self.names], np.int64)
        self.known: dict[bytes, tuple] = {}
        self.older: dict[bytes, tuple] = {}

    def align(self, keys: list[bytes]) -> list[tuple[int, bytes, str] | None]:
        """Of each window: its number of groups, its links (packed pairs of 8 bytes) and the text of its groups; None if its bytes differ.

        A window is the bytes of its ids: those of A, then those of B with OF_B added. Both spell equally many bytes, so
        byte offsets over all windows together stay in step.
        """
        if not keys:
            return []
        flat = np.frombuffer(b"".join(keys), "<i4")
        window = np.repeat(np.arange(len(keys)), [len(k) // 4 for k in keys])
        is_b = flat >= OF_B
        a, b, window_a = flat[~is_b].astype(np.int64), flat[is_b].astype(np.int64) - OF_B, window[~is_b]
        ends_a, ends_b = np.cumsum(self.of_a.length[a]), np.cumsum(self.of_b.length[b])
        # Two tokens overlap once between each two neighbouring ends.
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        links = (a[at_a] << 32 | b[at_b]).astype("<i8").tobytes()
        to_link = (np.cumsum(np.bincount(window_a[at_a], minlength=len(keys))) * 8).tolist()
        shared = ends[(ends_a[at_a] == ends) & (ends_b[at_b] == ends)]
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        to_a, to_b = np.cumsum(np.bincount(group_a)), np.cumsum(np.bincount(group_b))
        groups = np.bincount(window_a[to_a - 1], minlength=len(keys)).tolist()
        # The text of all groups: the ids of A, then those of B, each with what follows it.
        place_a = np.arange(len(a)) + np.append(0, to_b)[group_a]
        place_b = np.arange(len(b)) + to_a[group_b]
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[to_a - 1], last_b[to_b - 1] = 1, 2
        written = np.empty(len(flat), np.int64)
        written[place_a], written[place_b] = a * len(SEPARATORS) + last_a, b * len(SEPARATORS) + last_b
        text = "".join([self.names[i] for i in written.tolist()])
        to_id = np.cumsum(np.bincount(window))
        to_char = np.cumsum(self.name_length[written])[to_id - 1].tolist()
        out: list[tuple[int, bytes, str] | None] = [
            (n, links[l0:l1], text[c0 : c1 - 1])  # without the last separator
            for n, l0, l1, c0, c1 in zip(groups, [0, *to_link], to_link, [0, *to_char], to_char)
        ]
        raw_a, raw_b = b"".join([self.of_a.raw[i] for i in a.tolist()]), b"".join([self.of_b.raw[i] for i in b.tolist()])
        if raw_a != raw_b:
            to_byte = ends_a[np.cumsum(np.bincount(window_a)) - 1].tolist()
            for w, (start, end) in enumerate(zip([0, *to_byte], to_byte)):
                if raw_a[start:end] != raw_b[start:end]:
                    out[w] = None
        return out

    def look_up(self, keys: list[bytes]) -> list[tuple[int, bytes, str] | None]:
        """`align` from memory; new windows are aligned together. The older half of what is known goes when it is full."""
        known = self.known
        missing = {k for k in keys if k not in known}
        known.update((k, self.older[k]) for k in missing if k in self.older)
        new = [k for k in missing if k not in known]
        known.update(zip(new, self.align(new)))
        out = [known[k] for k in keys]
        for k in new:
            if len(k) > MEMO_TOKENS * 4:
                del known[k]
        if len(known) > MEMO_WINDOWS:
            self.known, self.older = {}, known
        return out

    def windows(self, text: str, b: list[int]) -> tuple[int, int, list[bytes]]:
        """n_a, n_b and the windows of a text, given its ids of B; no windows if the bytes of one tokenizer are not space+text."""
        ids_a = self.a.encode_ordinary(" " + text)
        if not text or not b or self.a.decode_bytes(ids_a) != (" " + text).encode():
            return 0, 0, []
        a, b = np.array(ids_a, "<i4"), np.array(b, "<i4")
        ends_a, ends_b = np.cumsum(self.of_a.length[a]), np.cumsum(self.of_b.length[b])
        if ends_a[-1] != ends_b[-1]:
            return 0, 0, []
        number = np.full(ends_b[-1] + 1, -1, np.int64)
        number[ends_b] = np.arange(len(b))
        at = number[ends_a]
        last_a = np.nonzero(at >= 0)[0]
        last_b = at[last_a]
        # The end of the text is an anchor; of the other shared ends those before a marked token of each.
        anchor = np.append(self.of_a.marked[a[last_a[:-1] + 1]] & self.of_b.marked[b[last_b[:-1] + 1]], True)
        cut_a, cut_b = last_a[anchor] + 1, last_b[anchor] + 1
        # One array of all windows: the ids of A, then those of B.
        both = np.empty(len(a) + len(b), "<i4")
        both[np.arange(len(a)) + np.repeat(np.append(0, cut_b[:-1]), np.diff(cut_a, prepend=0))] = a
        both[np.arange(len(b)) + np.repeat(cut_a, np.diff(cut_b, prepend=0))] = b + OF_B
        raw, ends = both.tobytes(), ((cut_a + cut_b) * 4).tolist()
        return len(a), len(b), [raw[i:j] for i, j in zip([0, *ends], ends)]

    def aligned(self, batch: list[str]) -> Iterator[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """n_a, n_b, n_groups, n_links, groups_sha256, the linked pairs and how often each is linked, of each text."""
        cut = [self.windows(*both) for both in zip(batch, self.b.encode(batch, num_threads=1))]
        found = self.look_up(list(chain.from_iterable([keys for _, _, keys in cut])))
        at = 0
        for n_a, n_b, keys in cut:
            mine = found[at : at + len(keys)]
            at += len(keys)
            if not mine or None in mine:  # B changes the text
                yield 0, 0, 0, 0, "", NONE, NONE
                continue
            links = np.frombuffer(b"".join([links for _, links, _ in mine]), "<i8")
            digest = hashlib.sha256(";".join([groups for _, _, groups in mine]).encode()).hexdigest()
            yield n_a, n_b, sum([n for n, _, _ in mine]), len(links), digest, *np.unique(links, return_counts=True)


@functools.cache
def aligner(path_a: str, path_b: str, pattern: str) -> Aligner:
    """One per Python worker and pair of files, so that the memo lives on between tasks."""
    return Aligner(path_a, path_b, pattern)


FACTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def aligned(docs: DataFrame, path_a: str, path_b: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (a number per row), the facts of its alignment, and its distinct pairs with their number of links."""

    def build():
        align = aligner(path_a, path_b, pattern).aligned

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_a, n_b, n_groups, n_links, digests, pairs, times = zip(*align(texts(batch.column(2))))
            offsets = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
            flat = lambda parts, kind: pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts), kind))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)),
                    pa.array(digests, pa.string()), flat(pairs, pa.int64()), flat(times, pa.int64()),
                ],
                names=["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )

        return one

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    return map_batches(rows, build, f"doc_id long, row long, {FACTS}, pairs array<long>, times array<long>", rows=200)


def pair_counts(coded: DataFrame) -> DataFrame:
    """pair, n_docs and is_best (n_docs is the highest of the pair's A id) over all documents."""
    counts = staged(coded.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs")))
    # One row per A id: bounded by the vocabulary.
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n_docs").alias("highest"))
    joined = counts.withColumn("a", F.shiftright("pair", 32)).join(F.broadcast(highest), "a")
    return staged(joined.select("pair", "n_docs", (F.col("n_docs") == F.col("highest")).alias("is_best")))


def alignment(
    docs: DataFrame, path_a: str, path_b: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", hot_share: int = HOT_SHARE
) -> DataFrame:
    """Per document: token numbers, groups, links, and how the links' pairs stand in the whole corpus."""
    coded = staged(aligned(docs, path_a, path_b, pattern, id_col, text_col))
    counts = pair_counts(coded)
    total = counts.agg(F.sum("n_docs")).first()[0] or 0
    is_hot = F.col("n_docs") * hot_share > total
    hot, cold = F.broadcast(counts.where(is_hot)), counts.where(~is_hot)
    links = coded.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    known = links.join(hot, "pair").unionByName(links.join(hot.select("pair"), "pair", "left_anti").join(cold, "pair"))
    sums = known.groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n_docs")).alias("count_sum")
    )
    facts = coded.drop("pairs", "times").join(sums, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return facts.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
