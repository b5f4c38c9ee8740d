"""Integer k-means whose assignment is filtered in a PCA-rotated space.

Components become integers floor(scale * x). One pass sums the moments of all vectors; their principal axes give a
rotation. Of each vector the leading rotated coordinates and the norm of the rest (its residual) are stored beside the
integers. For a centroid, squared distance of the leading coordinates plus squared difference of the residual norms is
a lower bound of the squared distance. The centroid with the least bound is verified in integers, then each other one
whose bound (less a margin for rounding) does not exceed that distance. Results are exact; the rotation only saves work.

A round sends eight centroids out and one row of sums per task and cluster back. Nothing else passes the driver.

Defined cases: vectors that are null, have another length or hold null or non-finite components are left out, as are
those with an integer of 2^28 or more, whose squared distances do not fit a long. Repeated rows count each time. Equal
seed hashes (repeated ids) are ordered by their components; null ids come last. Fewer vectors than centroids make
fewer centroids; an empty table gives no rows. Other columns are ignored, so their names may clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

LIMIT = 1 << 28


def integer_vectors(rows: DataFrame, dims: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, q (array<long>) of the vectors that are kept."""
    x = F.transform(vector_col, lambda v: v.cast("double"))
    whole = (F.size(vector_col) == dims) & F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v * scale) < LIMIT), F.lit(False))
    )
    kept = rows.where(F.coalesce(whole, F.lit(False)))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("q"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an array column of fixed length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def moments(vectors: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of vectors, their sum and their sum of outer products (doubles; they only shape the rotation)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims))
        n = 0
        for batch in batches:
            x = matrix(batch.column(0), dims).astype(np.float64)
            total[0] += x.sum(axis=0)
            total[1:] += x.T @ x
            n += len(x)
        if n:
            flat = np.append(total.ravel(), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["i", "v"])

    sums = vectors.select("q").mapInArrow(task, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    if not sums:
        return 0, np.zeros(dims), np.zeros((dims, dims))
    flat = np.zeros((dims + 1) * dims + 1)
    for row in sums:
        flat[row["i"]] = row["v"]
    total = flat[:-1].reshape(dims + 1, dims)
    return int(flat[-1]), total[0], total[1:]


class Rotation:
    """Leading principal axes of all vectors, around their mean."""

    def __init__(self, n: int, total: np.ndarray, outer: np.ndarray, leading: int):
        self.mean = total / max(n, 1)
        _, axes = np.linalg.eigh(outer / max(n, 1) - np.outer(self.mean, self.mean))
        self.axes = axes[:, ::-1][:, :leading]

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and residual norm of each row."""
        centred = x - self.mean
        lead = centred @ self.axes
        rest = np.einsum("ij,ij->i", centred, centred) - np.einsum("ij,ij->i", lead, lead)
        return lead, np.sqrt(np.maximum(rest, 0.0))


def rotated(vectors: DataFrame, rotation: Rotation, dims: int) -> DataFrame:
    """vec_id, q, lead, rest: the integers with what the filter needs."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = rotation(matrix(batch.column(1), dims).astype(np.float64))
            k = lead.shape[1]
            offsets = pa.array(np.arange(len(lead) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(lead.ravel())), pa.array(rest)],
                names=["vec_id", "q", "lead", "rest"],
            )

    return vectors.mapInArrow(task, "vec_id long, q array<long>, lead array<double>, rest double")


def nearest(q: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and exact squared distance of each row; the smaller number wins ties."""
    c_lead, c_rest = rotation(centroids.astype(np.float64))
    squares = lambda a: np.einsum("ij,ij->i", a, a)
    bound = squares(lead)[:, None] + squares(c_lead)[None, :] - 2 * lead @ c_lead.T + (rest[:, None] - c_rest[None, :]) ** 2
    # Rounding errors are relative to the squared lengths (around the mean and around zero). A residual norm is the root
    # of a difference, so its error is the root of a double's.
    size = (squares(lead) + rest**2)[:, None] + (squares(c_lead) + c_rest**2)[None, :] + squares(rotation.mean[None, :])
    bound -= 1e-7 * size + 1e-3
    exact = lambda rows, j: squares(q[rows] - centroids[j])
    cluster = bound.argmin(axis=1)
    distance = squares(q - centroids[cluster])
    for j in range(len(centroids)):
        rows = np.nonzero((bound[:, j] <= distance) & (cluster != j))[0]
        if len(rows):
            d = exact(rows, j)
            better = (d < distance[rows]) | ((d == distance[rows]) & (j < cluster[rows]))
            cluster[rows[better]], distance[rows[better]] = j, d[better]
    return cluster, distance


def _assign(batch: pa.RecordBatch, centroids: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    q = matrix(batch.column("q"), centroids.shape[1])
    lead = matrix(batch.column("lead"), rotation.axes.shape[1])
    return q, *nearest(q, lead, batch.column("rest").to_numpy(), centroids, rotation)


def recentred(vectors: DataFrame, centroids: np.ndarray, rotation: Rotation) -> np.ndarray:
    """One round: every non-empty centroid replaced by the floor of its vectors' exact mean."""
    k, dims = centroids.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            q, cluster, _ = _assign(batch, centroids, rotation)
            for j in np.unique(cluster):
                mine = q[cluster == j]
                sums[j] += mine.sum(axis=0)
                counts[j] += len(mine)
        some = np.nonzero(counts)[0]
        parts = [pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(parts, names=["cluster", "n", "sums"])

    parts = vectors.select("q", "lead", "rest").mapInArrow(task, "cluster int, n long, sums array<long>")
    wide = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *wide).collect():  # one row per cluster
        out[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dims)]
    return out


def seeds(vectors: DataFrame, k: int, salt: int) -> np.ndarray:
    """The `k` vectors with the least sha256 of `salt:id`."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(order.alias("h"), "q").orderBy(F.col("h").asc_nulls_last(), "q").limit(k).collect()
    return np.array([row["q"] for row in first], np.int64)


def clusters(
    rows: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, salt: int = 3, leading: int = 16,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of every kept vector after `rounds` rounds, and the final centroids."""
    empty = "vec_id long, cluster int, distance long"
    vectors = staged(integer_vectors(rows, dims, scale, id_col, vector_col))
    n, total, outer = moments(vectors, dims)
    if n == 0:
        return rows.sparkSession.createDataFrame([], empty), np.zeros((0, dims), np.int64)
    rotation = Rotation(n, total, outer, min(leading, dims))
    vectors = staged(rotated(vectors, rotation, dims))
    centroids = seeds(vectors, k, salt)
    for _ in range(rounds):
        centroids = recentred(vectors, centroids, rotation)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance = _assign(batch, centroids, rotation)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return staged(vectors.mapInArrow(task, empty)), centroids


def cluster_report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of what `clusters` returned."""
    spark = assigned.sparkSession
    digests = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    # One row per centroid.
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = sums.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy(F.lit(0)))).join(named, "cluster")
    return assigned.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
