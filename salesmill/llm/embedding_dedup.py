"""Embedding near-dedup: an exact metric range join on unit vectors.

Cosine >= t on unit vectors is Euclidean distance <= r = sqrt(2 - 2t). Pivots cut the space into cells (a vector's home
is its nearest pivot). A vector also goes, as a guest, to each cell that could hold a partner: by the triangle
inequality d(x, p_home) and d(x, p) differ by less than 2r, x lies within r of the ball around the cell's pivot, and its
distance to the bisecting hyperplane is at most r. Of two cells only the one with the larger number receives guests of
the other, so a pair meets once. Cells join independently; a large cell is cut into blocks, each joined on its own with
the cell's guests and the blocks after it, so no cell has to fit one task.

Equal vectors are one row with a weight until the end. Partners are counted exactly, in double precision; components
come from spanning links, not all pairs. Vectors that are null, zero, or hold null or non-finite components link with
nothing; vectors of different lengths are never compared. Null ids are counted but never name a component unless alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .graph import components

BLOCK = 4096
ROUNDING = 1e-6


def unit_rows(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (double array) of the vectors that can link, and null for the others."""
    vec = F.col("vec")
    good = (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists("vec", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return rows.select("id", F.when(F.coalesce(good, F.lit(False)), F.transform(vec, lambda x: x + F.lit(0.0))).alias("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so that no square over- or underflows."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = rows.offsets.to_numpy()
    dims = offsets[1] - offsets[0] if len(rows) else 0
    x = rows.values.to_numpy()[offsets[0] : offsets[-1]].reshape(len(rows), dims).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_dims(column: pa.Array) -> Iterator[np.ndarray]:
    """Row numbers, grouped by vector length."""
    lengths = np.diff(column.offsets.to_numpy())
    for dims in np.unique(lengths):
        yield np.flatnonzero(lengths == dims)


def spread(distinct: DataFrame, pivots: dict[int, np.ndarray], radii: dict[int, np.ndarray], r: float) -> DataFrame:
    """dims, cell, home, rep, weight, vec: each vector in its home cell and, as a guest, where a partner may be."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _by_dims(batch.column("vec")):
                part = batch.take(pa.array(rows))
                x = _matrix(part.column("vec"))
                dims = x.shape[1]
                p = pivots[dims]
                dots = x @ p.T
                d = np.sqrt(np.maximum(2 - 2 * dots, 0))
                home = d.argmin(1)
                at_home = d[np.arange(len(x)), home][:, None]
                between = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))[home]
                margin = (dots[np.arange(len(x)), home][:, None] - dots) / np.maximum(between, 1e-12)
                slack = r + ROUNDING
                go = (d - at_home <= 2 * slack) & (d <= radii[dims][None, :] + slack) & (margin <= slack)
                go &= np.arange(len(p))[None, :] > home[:, None]
                go[np.arange(len(x)), home] = True
                row, cell = np.nonzero(go)
                out = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), dims, np.int32)), pa.array(cell.astype(np.int32)), pa.array(cell == home[row]),
                        out.column("rep"), out.column("weight"), out.column("vec"),
                    ],
                    names=["dims", "cell", "home", "rep", "weight", "vec"],
                )

    return distinct.select("rep", "weight", "vec").mapInArrow(task, "dims int, cell int, home boolean, rep long, weight long, vec array<double>")


def cell_radii(distinct: DataFrame, pivots: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The largest distance of a home vector to each pivot: one small row per task and pivot is combined."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = {dims: np.full(len(p), -1.0) for dims, p in pivots.items()}
        for batch in batches:
            for rows in _by_dims(batch.column("vec")):
                x = _matrix(batch.column("vec").take(pa.array(rows)))
                d = np.sqrt(np.maximum(2 - 2 * x @ pivots[x.shape[1]].T, 0))
                np.maximum.at(most[x.shape[1]], d.argmin(1), d.min(1))
        flat = [(dims, i, v) for dims, values in most.items() for i, v in enumerate(values) if v >= 0]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat), (pa.int32(), pa.int32(), pa.float64()))] if flat else [pa.array([], t) for t in (pa.int32(), pa.int32(), pa.float64())], names=["dims", "cell", "d"])

    radii = {dims: np.full(len(p), -np.inf) for dims, p in pivots.items()}
    for row in distinct.select("vec").mapInArrow(task, "dims int, cell int, d double").groupBy("dims", "cell").agg(F.max("d").alias("d")).collect():
        radii[row.dims][row.cell] = row.d
    return radii


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
    """Merge the sets of `root` along the links (a, b); gives the new roots and only those links that joined sets.

    One link for each b is merged at a time; links inside a set then fall away at once.
    """
    used_a: list[int] = []
    used_b: list[int] = []
    while True:
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
        if not len(a):
            return root, used_a, used_b
        first = np.unique(b, return_index=True)[1]
        for i, j in zip(a[first].tolist(), b[first].tolist()):
            x, y = i, j
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                used_a.append(i)
                used_b.append(j)
        while ((up := root[root]) != root).any():
            root = up


def join_cell(left: pd.DataFrame, right: pd.DataFrame, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Partners of the rows of `left` (one block of home rows, joined with itself too) and `right`.

    Returns ids and partner weights of all of them, and spanning links (u, v).
    """
    rep = np.concatenate([left["rep"], right["rep"]]).astype(np.int64)
    weight = np.concatenate([left["weight"], right["weight"]]).astype(np.int64)
    x = np.stack([*left["vec"], *right["vec"]]).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = len(left)
    partners = np.zeros(len(rep), np.int64)
    root = np.arange(len(rep))
    links_u, links_v = [], []
    for start in range(0, len(rep), BLOCK):
        stop = min(start + BLOCK, len(rep))
        # Single precision finds candidates with room to spare, double precision decides.
        rough = x[:n].astype(np.float32) @ x[start:stop].astype(np.float32).T
        a, b = np.nonzero(rough >= cosine - 1e-4)
        b = b + start
        a, b = a[a < b], b[a < b]
        hit = np.concatenate([np.einsum("ij,ij->i", x[a[i : i + 65536]], x[b[i : i + 65536]]) >= cosine for i in range(0, len(a), 65536)] or [np.empty(0, bool)])
        a, b = a[hit], b[hit]
        # Sums of whole numbers below 2**53 are exact.
        partners += np.bincount(a, weight[b], len(rep)).astype(np.int64) + np.bincount(b, weight[a], len(rep)).astype(np.int64)
        root, u, v = unite(root, a, b)
        links_u.append(rep[u])
        links_v.append(rep[v])
    u, v = (np.concatenate([np.empty(0, np.int64), *x]) for x in (links_u, links_v))
    return rep, partners, u, v


def embedding_classes(
    vectors: DataFrame, cosine: float = 0.95, pivots: int = 32, pivot_sample: int = 2048, block_rows: int = BLOCK,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of `vectors`.

    `pivots` cells per vector length, chosen from at most `pivot_sample` distinct vectors by farthest-first order: only
    speed depends on them, every vector is joined.
    """
    spark = vectors.sparkSession
    rows = staged(unit_rows(vectors, id_col, vec_col))
    key = F.xxhash64("vec")
    # `rep` stands for equal vectors; ids may repeat or be null, so it is a number of its own.
    distinct = rows.where("vec is not null").groupBy("vec").agg(F.count("*").alias("weight"), F.min("id").alias("least"))
    distinct = staged(distinct.withColumn("rep", F.monotonically_increasing_id()))
    lengths = [r.n for r in distinct.select(F.size("vec").alias("n")).distinct().limit(1000).collect()]
    if len(lengths) == 1000:
        raise ValueError("vectors of a thousand different lengths are no embeddings")
    chosen = {}
    for dims in lengths:
        sample = distinct.where(F.size("vec") == dims).orderBy(key).limit(pivot_sample).select("vec").toArrow()
        x = _matrix(sample.column("vec"))
        pick, far = [0], np.full(len(x), np.inf)
        while len(pick) < min(pivots, len(x)):
            far = np.minimum(far, 1 - x @ x[pick[-1]])
            pick.append(int(far.argmax()))
        chosen[dims] = x[pick]
    radii = cell_radii(distinct, chosen) if chosen else {}
    placed = staged(spread(distinct, chosen, radii, float(np.sqrt(2 - 2 * cosine))))
    sizes = placed.groupBy("dims", "cell").agg(F.count_if("home").alias("n")).withColumn("blocks", F.ceil(F.greatest(F.col("n"), F.lit(1)) / block_rows).cast("int"))
    # A home row is in its own block and, like a guest, on the other side of the blocks before (guests: of all blocks).
    blocked = placed.join(F.broadcast(sizes), ["dims", "cell"]).withColumn(  # one row per cell: at most `pivots` per length
        "own", F.when(F.col("home"), F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    )
    last = F.coalesce("own", F.col("blocks") - 1)
    blocked = blocked.withColumn("block", F.explode(F.sequence(F.lit(0), last))).withColumn("home", F.coalesce(F.col("own") == F.col("block"), F.lit(False)))
    # Guests too are cut into blocks, so that a task's size is bounded on both sides.
    guests = blocked.where(~F.col("home")).groupBy("dims", "cell", "block").agg(F.count("*").alias("m"))
    guests = guests.withColumn("slices", F.ceil(F.col("m") / (8 * block_rows)).cast("int")).drop("m")
    blocked = blocked.join(F.broadcast(guests), ["dims", "cell", "block"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    piece = F.explode(F.when(F.col("home"), F.sequence(F.lit(0), F.col("slices") - 1)).otherwise(F.array(F.pmod(F.xxhash64("rep", F.lit(1)), F.col("slices")).cast("int"))))
    blocked = blocked.withColumn("piece", piece).select("dims", "cell", "block", "piece", "home", "rep", "weight", "vec")

    def join_group(pdf: pd.DataFrame) -> pd.DataFrame:
        home = pdf["home"].to_numpy(bool)
        none = pd.DataFrame({"u": pd.Series(dtype="int64"), "v": pd.Series(dtype="int64"), "partners": pd.Series(dtype="int64")})
        if not home.any():
            return none
        rep, partners, u, v = join_cell(pdf[home], pdf[~home], cosine)
        if pdf["piece"].iloc[0]:  # pairs inside the block are counted once, with the first slice
            _, inside, _, _ = join_cell(pdf[home], pdf[home].iloc[:0], cosine)
            partners[: len(inside)] -= inside
        some = np.flatnonzero(partners)
        return pd.concat([
            pd.DataFrame({"u": rep[some], "v": rep[some], "partners": partners[some]}),
            pd.DataFrame({"u": u, "v": v, "partners": np.zeros(len(u), np.int64)}),
        ])

    found = staged(blocked.groupBy("dims", "cell", "block", "piece").applyInPandas(join_group, "u long, v long, partners long"))
    counts = found.groupBy(F.col("u").alias("rep")).agg(F.sum("partners").alias("partners"))
    roots = components(found.where("u <> v").select("u", "v"))
    named = distinct.join(counts, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("component", "rep"))
    named = staged(named.select("vec", "weight", "least", F.coalesce("partners", F.lit(0)).alias("partners"), "root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_vec = named.join(ids, "root").select("vec", (F.col("partners") + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.join(by_vec, "vec", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
