"""Groups of documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash fingerprints of 64 bits within radius 3 stand for a similarity of about 0.97, so they alone miss most pairs above
0.8. Candidates are taken from several tables: the classes of the SimHash pivot tables, and `TABLES` independent
fingerprints, each of the `LEAST` smallest shingles under its own order (two documents of similarity s share one with a
probability of about s ** LEAST). A cell is one value of one table. Every link is verified by the exact Jaccard similarity.

Documents of equal shingle sets are one node. Cells of one node are dropped, and of cells with the same nodes one is
kept, so texts travel only for nodes that have a candidate. A cell gives back links that span its components. Cells of
more than `block_words` words are cut into blocks, dealt anew in every table; where a cut cell still holds several
components, everything outside of its largest one is compared with all its blocks. No cell has to fit one task, and
nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import long_list, map_batches, staged, texts
from .graph import components
from .simhash_dedup import fingerprint, fingerprint_links, shingle_hashes

WIDTH = 5
TABLES = 14
LEAST = 3
#: Similar from 4/5 on.
SIMILAR = (4, 5)
SEEDS = np.array([xxhash.xxh64_intdigest(b"order", t) for t in range(TABLES)], np.uint64)


def orders(shingles: np.ndarray) -> np.ndarray:
    """The place of each shingle in the order of each table."""
    x = (shingles[None, :] ^ SEEDS[:, None]) * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(29)
    return x


def table_keys(shingles: np.ndarray) -> list[int]:
    """One key for each table (signed): the hash of the least shingles under its order."""
    least = np.empty((TABLES, 0), np.uint64)
    for i in range(0, len(shingles), 65_536):
        least = np.concatenate([least, orders(shingles[i : i + 65_536])], axis=1)
        if least.shape[1] > LEAST:
            least = np.partition(least, LEAST - 1, axis=1)[:, :LEAST]
    least = np.sort(least, axis=1)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), t) for t, row in enumerate(least)], np.uint64).view(np.int64).tolist()


def marks(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """The key columns, node (hash of the shingle set), words (shingles in the set), fp (SimHash) and the tables' keys."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        node, words, fp, table = [], [], [], []
        for text in texts(batch.column("_text")):
            hashes = shingle_hashes(text, WIDTH)
            shingles = np.unique(hashes)
            node.append(xxhash.xxh64_intdigest(shingles.tobytes()))
            words.append(len(shingles))
            fp.append(fingerprint(hashes))
            table += table_keys(shingles)
        columns = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (node, fp)]
        tables = long_list(table, np.arange(len(node) + 1, dtype=np.int32) * TABLES)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in keys), columns[0], pa.array(words, pa.int64()), columns[1], tables], names=[*keys, "node", "words", "fp", "tables"]
        )

    rows = docs.select(*keys, F.col(text_col).alias("_text"))
    zero = F.lit(0).cast("long")
    return map_batches(rows, lambda: one, rows.select(*keys, zero.alias("node"), zero.alias("words"), zero.alias("fp"), F.array(zero).alias("tables")).schema)


def spanning(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what is connected by similarity: each set reached is compared with all that are not yet reached."""
    num, den = SIMILAR
    sizes = np.array([len(s) for s in sets])
    starts = np.append(0, np.cumsum(sizes))
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    out, left = [], np.ones(len(sets), bool)
    while left.any():
        frontier = [int(left.argmax())]
        left[frontier[0]] = False
        while frontier and left.any():
            p = frontier.pop()
            has = np.zeros(len(number), bool)
            has[number[starts[p] : starts[p + 1]]] = True
            common = np.bincount(owner[has[number]], minlength=len(sets))
            found = np.flatnonzero(left & (den * common >= num * (sizes + sizes[p] - common))).tolist()
            out += [(p, q) for q in found]
            frontier += found
            left[found] = False
    return out


def _links(rows: DataFrame) -> DataFrame:
    """u, v: verified links inside the cells of `rows` (cell, node, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, found = None, {}

        def close() -> pa.RecordBatch:
            nodes = list(found)
            pairs = spanning(list(found.values())) if len(nodes) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[p[i]] for p in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            for key, node, text in zip(batch.column("cell").to_pylist(), batch.column("node").to_pylist(), batch.column("text")):
                if key != cell:
                    if found:
                        yield close()
                    cell, found = key, {}
                if node not in found:
                    found[node] = np.unique(shingle_hashes(text.as_py() or "", WIDTH))
        if found:
            yield close()

    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("cell", "node", "text").repartition(partitions, "cell").sortWithinPartitions("cell").mapInArrow(task, "u long, v long")


def _with_texts(members: DataFrame, reps: DataFrame, docs: DataFrame, keys: list[str]) -> DataFrame:
    """`members` (with node) and the text of the node's first row."""
    return members.join(reps.select("node", *keys), "node").join(docs.select(*keys, "text"), keys).drop(*keys)


def classes_of(docs: DataFrame, keys: list[str], block_words: int = 200_000) -> DataFrame:
    """The key columns and component (a number of the group) for every row of `docs` (the keys, not null, and text)."""
    marked = staged(marks(docs, keys))
    least = F.min(F.struct(*keys)).alias("k")
    reps = staged(marked.groupBy("node").agg(least, F.first("words").alias("words"), F.first("tables").alias("tables")).select("node", "k.*", "words", "tables"))
    classes = components(fingerprint_links(marked.select("fp"))).withColumnRenamed("node", "fp")
    by_class = marked.select("node", "words", "fp").distinct().join(classes, "fp", "left")
    # A cell is named by the hash of its table's number and key.
    cells = staged(
        by_class.select(F.xxhash64(F.lit(-1), F.coalesce("component", "fp")).alias("cell"), "node", "words").distinct()
        .union(reps.select(F.posexplode("tables").alias("table", "key"), "node", "words").select(F.xxhash64("table", "key").alias("cell"), "node", "words"))
    )
    together = cells.groupBy("cell").agg(F.count("*").alias("n"), F.sum("words").alias("total"), F.bit_xor(F.xxhash64("node")).alias("who")).where("n > 1")
    chosen = together.groupBy("n", "total", "who").agg(F.min("cell").alias("cell"))
    members = staged(
        cells.join(chosen.select("cell", F.ceil(F.col("total") / block_words).cast("int").alias("blocks")), "cell")
        .withColumn("block", F.pmod(F.xxhash64("node", "cell"), F.greatest("blocks", F.lit(1))).cast("int"))
    )
    inside = members.select(F.xxhash64("cell", "block").alias("cell"), "node")
    links = staged(_links(_with_texts(inside, reps, docs, keys)))
    roots = staged(components(links))

    cut = members.where("blocks > 1").join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = cut.groupBy("cell", "component").agg(F.sum("words").alias("size"))
    open_cells = (
        sizes.groupBy("cell").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.sum("size").alias("total"), F.max("size").alias("largest"), F.count("*").alias("n"))
        .where("n > 1").select("cell", "main", F.ceil((F.col("total") - F.col("largest")) / block_words).cast("int").alias("others"))
    )
    open_cells = staged(open_cells)
    if not open_cells.isEmpty():
        rest = staged(cut.join(open_cells, "cell").withColumn("other", F.pmod(F.xxhash64("node", "cell"), F.greatest("others", F.lit(1))).cast("int")))
        row = rest.select("cell", "node", "block", F.explode(F.sequence(F.lit(0), F.greatest("others", F.lit(1)) - 1)).alias("other"))
        column = rest.where("component <> main").select("cell", "node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "other")
        across = row.union(column).select(F.xxhash64("cell", "block", "other").alias("cell"), "node").distinct()
        roots = staged(components(links.union(staged(_links(_with_texts(across, reps, docs, keys))))))
    return marked.select(*keys, "node").join(roots, "node", "left").select(*keys, F.coalesce("component", "node").alias("component"))
