"""SimHash near-dedup with pivot distance tables.

Every fingerprint gets its Hamming distances to 65 reference fingerprints (pivots): pivot j has its j lowest bits set.
By the triangle inequality two fingerprints within r differ by at most r in every coordinate of that table.

Cells: going from pivot to pivot, the distance profile rises or falls by one; two fingerprints within r take different
steps at r places at most, so of g > r groups of steps at least g - r are equal. A cell is one choice of g - r groups
and their steps; more groups make narrower cells, in more tables. In a cell, pairs whose coordinates differ by more than
r are discarded, and survivors are verified. A cell gives back links that span its components, not all pairs: members
already joined are not compared again, and small cells are compared as one block of arrays. Equal fingerprints are one
row throughout. Cells above `cell_limit` fingerprints are cut into blocks, and pairs of blocks are compared, each in
its own task, so no cell has to fit one task and nothing is left out.

Null text has no words and the fingerprint zero, which links like any other. Null ids never name a component unless
nothing else is in it. An empty table gives no rows; rows pass one to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, staged, texts
from .graph import components
from .line_dedup import LOWER

BITS = 64
SHIFT = np.uint64(1 << 63)


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 (seed 42) of the lower-cased text's word shingles, repeats included."""
    words = text.translate(LOWER).encode().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    shingles = map(join, zip(*(words[i:] for i in range(width))))
    return np.fromiter((digest(s, 42) for s in shingles), np.uint64, len(words) - width + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65_536):
        block = hashes[i : i + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keys: list[str], width: int = 5, text_col: str = "text") -> DataFrame:
    """The key columns and fp (the 64 bits as a signed long): one row per row of `docs`."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(shingle_hashes(t, width)) for t in texts(batch.column("_text"))]
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(np.array(fps, np.uint64).view(np.int64))], names=[*keys, "fp"])

    rows = docs.select(*keys, F.col(text_col).alias("_text"))
    return map_batches(rows, lambda: one, rows.select(*keys, F.lit(0).cast("long").alias("fp")).schema)


def pivots() -> np.ndarray:
    return np.array([(1 << j) - 1 for j in range(BITS + 1)], np.uint64)


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each pivot."""
    return np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype(np.int8)


def profile_groups(table: np.ndarray, groups: int) -> np.ndarray:
    """The steps of each group of neighbouring pivots as a number: bit k is set where the distance falls."""
    falls = np.diff(table, axis=1) < 0
    bounds = np.linspace(0, BITS, groups + 1).astype(int)
    return np.stack([falls[:, a:b] @ (np.uint64(1) << np.arange(b - a, dtype=np.uint64)) for a, b in zip(bounds, bounds[1:])], axis=1)


def within(fps: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs (a, b) are within the radius: discard by the largest coordinate difference, verify the rest.

    Coordinates are looked at one after another, the far pivots first, each over what the ones before left.
    """
    left = np.arange(len(a))
    for j in range(BITS, -1, -8):
        left = left[np.abs(table[a[left], j] - table[b[left], j]) <= radius]
    left = left[np.abs(table[a[left]] - table[b[left]]).max(1, initial=0) <= radius]
    return left[np.bitwise_count(fps[a[left]] ^ fps[b[left]]) <= radius]


def spanning(fps: np.ndarray, table: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that connect what is connected within the radius: each point reached is compared with what is not yet reached."""
    left, out_a, out_b = np.arange(len(fps)), [], []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            p = frontier.pop()
            hit = within(fps, table, np.full(len(left), p), left, radius)
            if len(hit):
                found = left[hit]
                out_a += [p] * len(found)
                out_b += found.tolist()
                frontier += found.tolist()
                left = np.delete(left, hit)
    return out_a, out_b


def links_in_cells(cell: np.ndarray, fps: np.ndarray, radius: int, small: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Links inside cells: rows of a cell are neighbours in the arrays."""
    table = pivot_table(fps)
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.empty(0, int)
    sizes = np.diff(np.append(starts, len(cell)))
    out_a, out_b = [], []
    in_small = np.repeat(sizes <= small, sizes)
    for shift in range(1, small):  # pairs `shift` apart, of all small cells at once
        a = np.flatnonzero(in_small[:-shift] & (cell[:-shift] == cell[shift:])) if len(cell) > shift else np.empty(0, int)
        if not len(a):
            break
        hit = within(fps, table, a, a + shift, radius)
        out_a.append(a[hit])
        out_b.append(a[hit] + shift)
    for start, size in zip(starts[sizes > small], sizes[sizes > small]):
        a, b = spanning(fps[start : start + size], table[start : start + size], radius)
        out_a.append(np.array(a, int) + start)
        out_b.append(np.array(b, int) + start)
    a, b = (np.concatenate([np.empty(0, int), *x]) for x in (out_a, out_b))
    return fps[a], fps[b]


def _cells(distinct: DataFrame, groups: int, radius: int) -> DataFrame:
    """cell, fp: each fingerprint in its cell of every table."""
    tables = list(combinations(range(groups), groups - radius))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column("fp").to_numpy().view(np.uint64)
        steps = profile_groups(pivot_table(fps), groups)
        width = -(-BITS // groups)
        keys = []
        for number, chosen in enumerate(tables):
            key = np.zeros(len(fps), np.uint64)
            for g in chosen:
                key = key << np.uint64(width) | steps[:, g]
            keys.append(key * np.uint64(len(tables)) + np.uint64(number))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(fps.view(np.int64), len(tables)))], names=["cell", "fp"])

    return map_batches(distinct, lambda: one, "cell long, fp long")


def _emit(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate([np.empty(0, np.uint64), *x]).view(np.int64) for x in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 2
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])


def fingerprint_links(fps: DataFrame, radius: int = 3, cell_limit: int = 20_000) -> DataFrame:
    """u, v: links whose components are those of all pairs of fingerprints (column fp) within the radius."""
    distinct = staged(fps.select("fp").distinct())
    # Narrower cells (in more tables) before they hold eight fingerprints each on average, so work grows with the rows.
    groups = radius + 1
    n = distinct.count()
    while groups < 2 * radius + 2 and n > 1 << (BITS * (groups - radius) // groups) + 3:
        groups += 1
    cells = staged(_cells(distinct, groups, radius))
    large = cells.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_limit)
    # Fewer than rows / cell_limit cells.
    large = staged(large)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("cell").to_numpy(), b.column("fp").to_numpy()) for b in batches]
        if parts:
            cell, fp = (np.concatenate(x) for x in zip(*parts))
            yield _emit([links_in_cells(cell, fp.view(np.uint64), radius)])

    partitions = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordinary = cells.join(large, "cell", "left_anti").select("cell", "fp").repartition(partitions, "cell").sortWithinPartitions("cell")
    links = ordinary.mapInArrow(compare, "u long, v long")
    if large.isEmpty():
        return links
    # Blocks of a large cell: a row goes to every pair of blocks that holds its own.
    blocks = F.ceil(F.col("n") / F.lit(cell_limit // 2)).cast("int")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    paired = (
        cells.join(large, "cell").withColumn("blocks", blocks).withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), "fp")
    )
    return links.union(paired.repartition(partitions, "cell").sortWithinPartitions("cell").mapInArrow(compare, "u long, v long"))


def classes_of(
    docs: DataFrame, keys: list[str], id_col: str, width: int = 5, radius: int = 3, text_col: str = "text", cell_limit: int = 20_000
) -> DataFrame:
    """The key columns (`id_col` among them), fp, component (a fingerprint of the class) and component_id (its least id)."""
    fps = staged(fingerprints(docs, keys, width, text_col))
    least = fps.groupBy("fp").agg(F.min(id_col).alias("_least"))
    roots = components(fingerprint_links(fps, radius, cell_limit))
    named = staged(least.join(roots, least["fp"] == roots["node"], "left").select("fp", "_least", F.coalesce("component", "fp").alias("component")))
    ids = named.groupBy("component").agg(F.min("_least").alias("component_id"))
    return fps.join(named.join(ids, "component").select("fp", "component", "component_id"), "fp")


def simhash_classes(
    docs: DataFrame, width: int = 5, radius: int = 3, id_col: str = "doc_id", text_col: str = "text", cell_limit: int = 20_000
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of `docs`."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    classes = classes_of(rows, ["doc_id"], "doc_id", width, radius, "text", cell_limit)
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
