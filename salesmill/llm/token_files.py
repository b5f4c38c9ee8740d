"""Token ids in ORC: written in ascending document order, read back stripe by stripe.

Documents are range-partitioned by id and sorted before they are encoded, so files and stripes hold disjoint id ranges
(row indexes prune by them, Bloom filters answer point lookups) and ids of a document are written once, in order. ORC
run-length encodes the integers. Offsets need no global sort: totals per file are summed, and documents count on from
their file's start. Null text counts as empty (the end id only); null ids come first; equal rows keep their own place.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_bpe import Pieces, id_lists, lists
from .common import map_batches, staged, texts
from .token_counts import byte_symbols

OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "10000",
    "orc.stripe.size": str(64 << 20),
}

#: The pretoken pattern of byte-level vocabularies: it leaves a space and the ASCII letters after it whole.
WORDS_WHOLE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids as the tokenizers library gives them, from a memo of pieces; the library's model encodes what is new.

    For byte-level vocabularies without a normalizer (as the .json file says; anything else is refused).
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("normalizer") or spec["pre_tokenizer"] != spec["pre_tokenizer"] | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
            raise ValueError("a byte-level vocabulary without a normalizer or prefix space is needed")
        self.library = Tokenizer.from_file(path)
        model = self.library.model
        shown = {i: s for i, s in enumerate(byte_symbols())}
        find = regex.compile(pattern).findall

        space, words = shown[0x20], pattern == WORDS_WHOLE

        def encode(piece: str) -> bytes:
            word = piece[1:]
            if words and word.isascii() and word.isalpha() and piece[0] == " ":  # one pretoken, as most pieces are
                ids = [t.id for t in model.tokenize(space + word)]
            else:
                ids = []
                for match in find(piece):
                    ids += [t.id for t in model.tokenize(match.encode().decode("latin-1").translate(shown))]
            return struct.pack(f"<{len(ids)}i", *ids)

        self.pieces = Pieces(encode)
        self.special = [t["content"] for t in spec["added_tokens"]]

    def encode(self, text: str, end: bytes = b"") -> np.ndarray:
        """The ids of `text`, then those in `end` (4 bytes each)."""
        if any(s in text for s in self.special):  # added tokens are the library's own matter
            ids = self.library.encode(text, add_special_tokens=False).ids
            return np.frombuffer(np.array(ids, "<i4").tobytes() + end, "<i4")
        return np.frombuffer(b"".join([*self.pieces(text), end]), "<i4")


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def write_tokens(
    docs: DataFrame, folder: str, path: str, pattern: str, end_id: int = 2, files: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", options: dict[str, str] | None = None,
) -> None:
    """Encode `docs` and write doc_id, part, ids to ORC files in `folder`; part numbers the id ranges in order.

    options: of the ORC writer, over OPTIONS.
    """
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id")
        .select("doc_id", F.spark_partition_id().alias("part"), "text")
    )

    def build():
        encode = encoder(path, pattern).encode
        end = np.array([end_id], "<i4").tobytes()
        return lambda batch: pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), id_lists([encode(t, end) for t in texts(batch.column(2))])],
            names=["doc_id", "part", "ids"],
        )

    map_batches(rows, build, "doc_id long, part int, ids array<int>").write.options(**OPTIONS | (options or {})).orc(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, part, ids; filters on doc_id reach the stripes' indexes and Bloom filters."""
    return spark.read.schema("doc_id long, part int, ids array<int>").orc(folder)


def token_index(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the tokens read: where each document begins in the stream of all ids."""

    def sums(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(len(ids), zlib.crc32(ids.tobytes())) for ids in lists(batch.column(2))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([n for n, _ in found], pa.int64()), pa.array([c for _, c in found], pa.int64())],
            names=["doc_id", "part", "n_tokens", "ids_crc32"],
        )

    # Four small columns, read twice below: the ids are read once.
    rows = staged(map_batches(tokens, lambda: sums, "doc_id long, part int, n_tokens long, ids_crc32 long"))
    ahead = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))  # one row per file
    starts = totals.select("part", ahead(Window.orderBy("part")).alias("before"))
    inside = rows.withColumn("inside", ahead(Window.partitionBy("part").orderBy("doc_id", "n_tokens", "ids_crc32")))
    return inside.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
