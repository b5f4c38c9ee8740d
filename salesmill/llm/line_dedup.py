"""Line dedup by range-partitioned hashes.

Lines become (128-bit key hash, document, position) rows, range-partitioned and sorted by all of these, so a key with a
third of all lines spreads over many tasks. Each task streams its sorted rows: first occurrences and documents per key
follow from neighbours alone. A key that crosses a partition's edge is settled with one small summary per partition
(first key, last key and their documents), so no key is ever gathered. What comes back is a compressed bitmap per
document, a bit per line, set where the line stays; texts are not part of it.

Documents are told apart by (id, text hash): rows with equal ids and different texts each keep their own bitmap but
count as one document. Null ids are an id of their own; null text is one empty line; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, map_batches, staged, texts

#: A-Z to a-z and nothing else.
LOWER = {c: c + 32 for c in range(65, 91)}
#: Ids sort below any real one when null.
NO_ID = -(1 << 63)


def key_of(line: str) -> str:
    return line.strip(BLANKS).translate(LOWER)


def _with_row(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("row"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )


def _line_rows(batch: pa.RecordBatch, min_chars: int) -> pa.RecordBatch:
    of, pos, high, low = [], [], [], []
    for i, text in enumerate(texts(batch.column("text"))):
        for n, line in enumerate(text.split("\n")):
            key = key_of(line)
            if len(key) >= min_chars:
                of.append(i)
                pos.append(n)
                digest = xxhash.xxh3_128_intdigest(key.encode())
                high.append((digest >> 64) - (1 << 63))
                low.append((digest & (1 << 64) - 1) - (1 << 63))
    take = np.array(of, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(high, pa.int64()), pa.array(low, pa.int64()), batch.column("doc").take(take), batch.column("row").take(take), pa.array(pos, pa.int32())],
        names=["high", "low", "doc", "row", "pos"],
    )


class Stream:
    """One sorted partition: where keys begin, how many documents each key has, and which line came first.

    Rows arrive in batches and are kept as plain arrays; range partitioning over all columns keeps partitions even.
    """

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        columns = [[b.column(name).to_numpy() for name in ("high", "low", "doc", "row", "pos")] for b in batches]
        empty = [np.empty(0, np.int64)] * 5
        self.high, self.low, self.doc, self.row, self.pos = (np.concatenate(c) for c in zip(*(columns or [empty])))
        n = len(self.high)
        self.new_key = np.ones(n, bool)
        self.new_key[1:] = (self.high[1:] != self.high[:-1]) | (self.low[1:] != self.low[:-1])
        self.new_doc = self.new_key.copy()
        self.new_doc[1:] |= self.doc[1:] != self.doc[:-1]
        self.key = np.cumsum(self.new_key) - 1
        self.docs = np.bincount(self.key, self.new_doc).astype(np.int64)
        self.starts = np.flatnonzero(self.new_key)
        start = self.starts[self.key]
        #: The first occurrence; rows that repeat it (equal tuples share a partition) count as it.
        self.first = (self.doc == self.doc[start]) & (self.row == self.row[start]) & (self.pos == self.pos[start])


def settle(edges: list[tuple]) -> dict[tuple[int, int], tuple[int, int]]:
    """From all partitions' edges in order: documents of each key that crosses an edge, and the partition it starts in."""
    found: dict[tuple[int, int], list[int]] = {}
    for part, high, low, docs, first, last in edges:
        known = found.get((high, low))
        if known is None:
            found[high, low] = [docs, part, last]
        else:  # a document that goes on over the edge counts once
            known[0] += docs - (known[2] == first)
            known[2] = last
    return {key: (docs, part) for key, (docs, part, _) in found.items()}


def dropped_lines(
    docs: DataFrame, min_docs: int = 1, keep_first: bool = True, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc, row, pos: the lines to drop, of keys found in `min_docs` documents or more.

    keep_first spares the first occurrence of each key (by document, then position).
    """
    spark = docs.sparkSession
    lines = staged(map_batches(_with_row(docs, id_col, text_col), lambda: lambda b: _line_rows(b, min_chars), "high long, low long, doc long, row long, pos int"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ("high", "low", "doc", "row", "pos")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines to drop for sure (null key), and all lines of the partition's first and last key, undecided (with key)."""
        s = Stream(batches)
        if not len(s.high):
            return
        edge = np.zeros(len(s.starts), bool)
        edge[[0, -1]] = True
        open_ = edge[s.key]
        sure = ~open_ & (s.docs[s.key] >= min_docs) & ~(s.first & keep_first)
        take = np.flatnonzero(open_ | sure)
        undecided, begins, opens = open_[take], s.first[take], s.new_key[take]
        last = np.append(s.starts[1:], len(s.high)) - 1
        of = s.key[take]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(s.doc[take]), pa.array(s.row[take]), pa.array(s.pos[take].astype(np.int32)),
                pa.array(s.high[take], mask=~undecided), pa.array(s.low[take], mask=~undecided), pa.array(begins),
                pa.array(s.docs[of], mask=~(undecided & opens)), pa.array(s.doc[last][of], mask=~(undecided & opens)),
            ],
            names=["doc", "row", "pos", "high", "low", "begins", "docs", "last"],
        )

    found = staged(
        lines.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(stream, "doc long, row long, pos int, high long, low long, begins boolean, docs long, last long")
        .withColumn("part", F.spark_partition_id())
    )
    # At most two rows for each partition.
    edges = found.where("docs is not null").select("part", "high", "low", "docs", "doc", "last").collect()
    crossing = spark.createDataFrame(
        [(*key, *value) for key, value in settle(sorted(map(tuple, edges))).items()], "high long, low long, total long, first_part int"
    )
    stays = (F.col("total") < min_docs) | (F.lit(keep_first) & F.col("begins") & (F.col("part") == F.col("first_part")))
    return found.join(F.broadcast(crossing), ["high", "low"], "left").where(F.col("high").isNull() | ~stays).select("doc", "row", "pos")


def pack(dropped: np.ndarray) -> bytes:
    """A compressed bitmap, a bit per line up to the last dropped one, set where the line stays."""
    keep = np.ones(-(-(int(dropped.max()) + 1) // 8) * 8 if len(dropped) else 0, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def unpack(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """Which of `n_lines` lines stay; lines beyond the bitmap do."""
    keep = np.ones(n_lines, bool)
    if bitmap:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines].astype(bool)
        keep[: len(bits)] = bits
    return keep


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """doc, row, bitmap: one row per document that loses a line."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("pos")
        flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        maps = [pack(flat[a:b]) for a, b in zip(offsets, offsets[1:])]
        return pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("row"), pa.array(maps, pa.binary())], names=["doc", "row", "bitmap"])

    grouped = dropped.groupBy("doc", "row").agg(F.collect_set("pos").alias("pos"))  # at most a document's lines
    return map_batches(grouped, lambda: one, "doc long, row long, bitmap binary")


def line_bitmaps(
    docs: DataFrame, min_docs: int = 1, keep_first: bool = True, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    return keep_bitmaps(dropped_lines(docs, min_docs, keep_first, min_chars, id_col, text_col))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", bitmap_col: str = "_bitmap") -> DataFrame:
    """`docs` with the column `bitmap_col` (null: every line stays), joined by id and text hash; `docs` must not have it."""
    right = bitmaps.select("doc", "row", F.col("bitmap").alias(bitmap_col))
    same = (F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)) == right["doc"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == right["row"])
    # The bitmaps are the small side: hashing them spares sorting the texts.
    joined = docs.join(right.hint("shuffle_hash"), same, "left")
    return joined.select(*[docs[c] for c in docs.columns], right[bitmap_col])


def kept_text(text: str, bitmap: bytes | None) -> tuple[str, int, int]:
    """The kept lines joined by \\n, the lines before, the lines dropped."""
    lines = text.split("\n")
    keep = unpack(bitmap, len(lines))
    return "\n".join(line for line, stays in zip(lines, keep) if stays), len(lines), int((~keep).sum())
