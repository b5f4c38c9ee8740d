"""Substring dedup with suffix automata of reference shards.

A window is `width` consecutive words of one document. Words covered by a window that also occurs in a document with a
smaller id are removed; windows are judged on the input.

Work is kept to what repeats. Of all `gram`-word grams in a window the one with the least hash is its anchor, so equal
windows have equal anchors; windows whose anchor occurs in one document only cannot repeat. The others form runs. Hashes
of their windows, combined map-side, name each repeated window's first document; its maximal repeated passages are the
reference, in which every repeated passage stands once. The reference is cut into shards of bounded size, each compiled
into a suffix automaton whose states know the least document they occur in. Runs are streamed past the automata of those
shards that hold one of their anchors, cut to the windows with such anchors, for matching statistics (the longest match ending at each word); where it reaches
the width and the matched window is in a smaller document, the window's words go. A shard is sent only to the tasks that
stream runs past it, since all shards together grow with the corpus; a shard with many runs is sent to several tasks.

Hashes only select; the automata compare words. Documents are told apart by (id, text hash), so rows with equal ids keep
their own results and never remove each other's words. Null ids come after all others and null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, long_list, map_batches, staged, texts

#: Null ids sort behind all others.
LAST_ID = (1 << 63) - 1
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class Windows:
    """Hashes of the grams and windows of a text's words."""

    def __init__(self, width: int, gram: int):
        self.width, self.gram = width, gram
        self.word = Recent(lambda w: xxhash.xxh3_64_intdigest(w, 10), 300_000)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            powers = np.full(n, BASE, np.uint64)
            inverses = np.full(n, BASE_INVERSE, np.uint64)
            powers[0] = inverses[0] = 1
            self.powers, self.inverses = np.cumprod(powers, dtype=np.uint64), np.cumprod(inverses, dtype=np.uint64)

    def _rolled(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """A polynomial hash modulo 2**64 of each `width` neighbours, mixed."""
        n = len(hashes)
        self._grow(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.powers[:n], dtype=np.uint64)])
        x = (sums[width:] - sums[:-width]) * self.inverses[: n - width + 1]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each window: its anchor, its hash."""
        if len(words) < self.width:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.word.__getitem__, words), np.uint64, len(words))
        least, span, wanted = self._rolled(hashes, self.gram), 1, self.width - self.gram + 1
        while span < wanted:  # minima of spans that double
            shift = min(span, wanted - span)
            least = np.minimum(least[:-shift], least[shift:])
            span += shift
        return least, self._rolled(hashes, self.width)


class Automaton:
    """A suffix automaton over words of several passages; `first` is the least document of each state's longest string."""

    def __init__(self, width: int):
        self.width = width
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [LAST_ID]

    def _new(self, length: int, arcs: dict[str, int], link: int, first: int) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.length) - 1

    def _split(self, p: int, word: str, q: int) -> int:
        """The state of the string of p plus `word`, where q holds it together with longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q], self.first[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[str], doc: int) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:  # another passage has this string
                last = self._split(last, word, q)
            else:
                p, new = last, self._new(self.length[last] + 1, {}, 0, LAST_ID)
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, word, self.next[p][word])
                last = new
            self.first[last] = min(self.first[last], doc)

    def finish(self) -> None:
        """Hand the least document up the suffix links; note for each state that of its window-long suffix."""
        order = np.argsort(self.length, kind="stable")
        for v in order[:0:-1].tolist():
            u = self.link[v]
            if self.first[v] < self.first[u]:
                self.first[u] = self.first[v]
        self.of_window = [LAST_ID + 1] * len(self.length)
        for v in order.tolist():
            if self.length[v] >= self.width:
                u = self.link[v]
                self.of_window[v] = self.of_window[u] if self.length[u] >= self.width else self.first[v]

    def stream(self, words: list[str], doc: int) -> list[tuple[int, int]]:
        """Maximal spans of words covered by windows that occur in a document before `doc`."""
        spans: list[list[int]] = []
        state, matched, width = 0, 0, self.width
        arcs, link, length, of_window = self.next, self.link, self.length, self.of_window
        for i, word in enumerate(words):
            to = arcs[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = arcs[state].get(word)
            if to is None:
                matched = 0
                continue
            state, matched = to, matched + 1
            if matched >= width:
                # The suffix of window length may belong to a shorter string's state.
                while length[link[state]] >= matched:
                    state = link[state]
                if of_window[state] < doc:
                    if spans and spans[-1][1] >= i + 1 - width:
                        spans[-1][1] = i + 1
                    else:
                        spans.append([i + 1 - width, i + 1])
        return [(a, b) for a, b in spans]


def _runs(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    """[start, end) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return zip(edges[::2].tolist(), edges[1::2].tolist())


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("row"),
        F.col(text_col).alias("text"),
    )


RUNS = "doc long, row long, start long, words string, anchors array<long>, hashes array<long>"


def _run_batch(windows: Windows, batch: pa.RecordBatch, shared_of) -> pa.RecordBatch:
    """The runs of windows whose anchor is shared; shared_of(row of the batch) gives sorted shared anchors."""
    at, starts, words_, anchors_, hashes_ = [], [], [], [], []
    for i, text in enumerate(texts(batch.column("text"))):
        words = text.encode().split()
        anchors, hashes = windows(words)
        shared = shared_of(i)
        if not len(anchors) or not len(shared):
            continue
        found = np.minimum(np.searchsorted(shared, anchors), len(shared) - 1)
        for a, b in _runs(shared[found] == anchors):
            at.append(i)
            starts.append(a)
            words_.append(b" ".join(words[a : b + windows.width - 1]).decode())
            anchors_.append(np.unique(anchors[a:b]).view(np.int64))
            hashes_.append(hashes[a:b].view(np.int64))
    take = np.array(at, np.int64)
    lists = [long_list(np.concatenate([np.empty(0, np.int64), *x]), np.concatenate([[0], np.cumsum([len(y) for y in x])]).astype(np.int32)) for x in (anchors_, hashes_)]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc").take(take), batch.column("row").take(take), pa.array(starts, pa.int64()), pa.array(words_, pa.string()), *lists],
        names=["doc", "row", "start", "words", "anchors", "hashes"],
    )


def repeated_runs(docs: DataFrame, width: int, gram: int, shared_limit: int) -> DataFrame:
    """Runs of windows whose anchor occurs in two documents or more."""
    spark = docs.sparkSession

    def anchors_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(windows(t.encode().split())[0]).view(np.int64) for t in texts(batch.column("text"))]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("row"), long_list(np.concatenate([np.empty(0, np.int64), *found]), offsets)], names=["doc", "row", "anchors"]
        )

    windows = Windows(width, gram)
    anchors = staged(map_batches(docs, lambda: anchors_of, "doc long, row long, anchors array<long>").where(F.size("anchors") > 0))
    each = anchors.select("doc", "row", F.explode("anchors").alias("anchor"))
    shared = staged(each.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("anchor"))
    if shared.count() <= shared_limit:  # checked: 8 bytes each
        known = np.sort(shared.toArrow().column("anchor").to_numpy().view(np.uint64))
        everyone = spark.sparkContext.broadcast(known)
        return map_batches(docs, lambda: lambda batch: _run_batch(windows, batch, lambda i: everyone.value), RUNS)
    own = each.join(shared, "anchor").groupBy("doc", "row").agg(F.collect_set("anchor").alias("shared"))
    with_own = docs.join(own.hint("shuffle_hash"), ["doc", "row"])

    def of_own(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("shared")
        flat, offsets = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        return _run_batch(windows, batch, lambda i: np.sort(flat[offsets[i] : offsets[i + 1]]))

    return map_batches(with_own, lambda: of_own, RUNS)


def _dealt(runs: DataFrame, reference: DataFrame, width: int, gram: int, task_words: int) -> tuple[DataFrame, DataFrame]:
    """The pieces of runs that are streamed past each shard, and the shards' passages, by shard and slice (the task's share of the pieces)."""
    windows = Windows(width, gram)
    holds = reference.select(F.explode("anchors").alias("anchor"), "shard").distinct()
    # Of a run, a shard gets only the windows whose anchors it holds: whole runs would be sent to more shards the more there are.
    wanted = staged(
        runs.select("doc", "row", "start", (F.size("hashes") + (width - 1)).alias("n"), F.explode("anchors").alias("anchor"))
        .join(holds, "anchor").groupBy("doc", "row", "start", "n", "shard").agg(F.collect_set("anchor").alias("held"))
        .withColumn("n", F.least("n", F.size("held") * (2 * width - gram)))  # words of the windows around so many anchors
    )
    slices = wanted.groupBy("shard").agg(F.ceil(F.sum("n") / task_words).cast("int").alias("slices"))  # one row per shard
    dealt = wanted.join(slices, "shard").withColumn("slice", F.pmod(F.xxhash64("doc", "row", "start"), F.col("slices")).cast("int"))
    # At most one entry per shard and anchor of the run.
    dealt = dealt.groupBy("doc", "row", "start").agg(F.collect_list(F.struct("shard", "slice", "held")).alias("to"))

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc, row, start, text, to in zip(*(batch.column(c).to_pylist() for c in ("doc", "row", "start", "words", "to"))):
            words = text.encode().split(b" ")
            anchors = windows(words)[0].view(np.int64)
            for one in to:
                for a, b in _runs(np.isin(anchors, np.array(one["held"], np.int64))):
                    out.append((one["shard"], one["slice"], doc, row, start + a, b" ".join(words[a : b + width - 1]).decode()))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*out)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["shard", "slice", "doc", "row", "start", "words"])

    each_run = runs.select("doc", "row", "start", "words").join(dealt, ["doc", "row", "start"])
    streamed = map_batches(each_run, lambda: pieces, "shard int, slice int, doc long, row long, start long, words string")
    sent = reference.join(slices, "shard").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    return streamed, sent


def removed_spans(
    docs: DataFrame, width: int = 50, gram: int = 16, shard_words: int = 150_000, task_words: int = 2_000_000,
    shared_limit: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc, row, spans (array of [start, end) word positions, may touch or overlap): the documents that lose words."""
    gram = min(gram, width)
    runs = staged(repeated_runs(_identified(docs, id_col, text_col), width, gram, shared_limit))
    firsts = (
        runs.select("doc", F.explode("hashes").alias("hash"))
        .groupBy("hash").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi")
        .groupBy(F.col("lo").alias("first_doc")).agg(F.collect_list("hash").alias("own"))  # at most a document's windows
    )
    windows = Windows(width, gram)

    def passages(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, anchors = [], []
        for doc, text, own in zip(*(batch.column(c).to_pylist() for c in ("doc", "words", "own"))):
            words = text.encode().split(b" ")
            anchor, hashes = windows(words)
            for a, b in _runs(np.isin(hashes.view(np.int64), np.array(own, np.int64))):
                out.append((doc, [w.decode() for w in words[a : b + width - 1]]))
                anchors.append(np.unique(anchor[a:b]).view(np.int64))
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in anchors])]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([doc for doc, _ in out], pa.int64()), pa.array([" ".join(words) for _, words in out], pa.string()),
                pa.array([len(words) for _, words in out], pa.int64()), long_list(np.concatenate([np.empty(0, np.int64), *anchors]), offsets),
            ],
            names=["doc", "words", "n", "anchors"],
        )

    owned = runs.join(firsts, runs["doc"] == firsts["first_doc"]).select("doc", "words", "own")
    reference = staged(map_batches(owned, lambda: passages, "doc long, words string, n long, anchors array<long>").distinct())
    shards = max(1, -(-(reference.agg(F.sum("n")).first()[0] or 0) // shard_words))
    reference = reference.withColumn("shard", F.pmod(F.xxhash64("doc"), F.lit(shards)).cast("int"))

    streamed, sent = _dealt(runs, reference, width, gram, task_words)

    def past(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        automaton = Automaton(width)
        for doc, words in zip(right["doc"], right["words"]):
            automaton.add(words.split(" "), int(doc))
        automaton.finish()
        out = [
            (doc, row, start + a, start + b)
            for doc, row, start, words in zip(left["doc"], left["row"], left["start"], left["words"])
            for a, b in automaton.stream(words.split(" "), int(doc))
        ]
        return pd.DataFrame(out, columns=["doc", "row", "start", "end"]).astype("int64")

    keys = ("shard", "slice")
    found = (
        streamed.select(*keys, "doc", "row", "start", "words").groupBy(*keys)
        .cogroup(sent.select(*keys, "doc", "words").groupBy(*keys))
        .applyInPandas(past, "doc long, row long, start long, end long")
    )
    return found.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def with_spans(docs: DataFrame, spans: DataFrame, broadcast_bytes: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the column `_spans` (null: nothing goes). Spans of up to `broadcast_bytes` are broadcast, else texts and spans are shuffled."""
    right = staged(spans.select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), F.col("spans").alias("_spans")))
    size = right.agg(F.sum(64 + 16 * F.size("_spans"))).first()[0] or 0
    right = F.broadcast(right) if size <= broadcast_bytes else right.hint("shuffle_hash")
    same = (F.coalesce(docs[id_col].cast("long"), F.lit(LAST_ID)) == right["_doc"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == right["_row"])
    return docs.join(right, same, "left").drop("_doc", "_row")


def kept_words(text: str, spans) -> tuple[list[bytes], int]:
    """The words that stay, and how many there were."""
    words = text.encode().split()
    gone = np.zeros(len(words), bool)
    for span in spans or ():
        gone[span["start"] : span["end"]] = True
    return [w for w, g in zip(words, gone.tolist()) if not g], len(words)
