"""Random samples of a fixed number of rows, of a table or of each of its groups."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F


def sample_rows(df: DataFrame, n: int = 100_000, seed: int = 7) -> DataFrame:
    """`n` random rows (all rows when there are fewer).

    Ordering every row by a random number would send up to `n` rows of each task to a single one. A first
    cut keeps just over `n` rows of the whole table, wide enough that falling short is all but impossible
    (ten standard deviations), and only those are ordered.
    """
    total = df.count()
    if total <= n:
        return df
    keep = (n + 10 * math.sqrt(n) + 100) / total
    numbered = df.withColumn("_u", F.rand(seed))
    return numbered.where(F.col("_u") < keep).orderBy("_u").limit(n).drop("_u")


def _leading(by: list[str], n: int):
    """The first `n` rows of each group in batches sorted by group: what one task has to send."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, taken = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c) for c in by]
            differs = np.zeros(batch.num_rows, bool)
            for key in keys:
                same = pc.fill_null(pc.equal(key[1:], key[:-1]), False).to_numpy(zero_copy_only=False)
                both_null = pc.and_(pc.is_null(key[1:]), pc.is_null(key[:-1])).to_numpy(zero_copy_only=False)
                differs[1:] |= ~(same | both_null)
            first = [key[0].as_py() for key in keys]
            if first != last:
                taken = 0
            starts = np.nonzero(differs)[0]
            # Place of each row in its group, counted on from the batch before.
            begun = np.zeros(batch.num_rows, np.int64)
            begun[starts] = starts
            begun = np.maximum.accumulate(begun)
            place = np.arange(batch.num_rows) - begun
            place[: starts[0] if len(starts) else batch.num_rows] += taken
            last, taken = [key[-1].as_py() for key in keys], int(place[-1]) + 1
            yield batch.filter(pa.array(place < n))

    return task


def sample_strata(df: DataFrame, n: int, by: list[str], seed: int = 7, buckets: int = 64) -> DataFrame:
    """Exactly `n` random rows of each group `by` (or of all, for an empty list); groups with fewer rows come whole.

    The rows with the least random numbers are taken. Each task sends its own `n` least per group, which `buckets` tasks
    per group thin out before one merges them, so no task sees a group and the input is read once. Numbers follow from
    the place of a row in the input: a retried task takes the same rows.
    """
    number, place = F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.monotonically_increasing_id()
    rows = df.withColumns({"_number": number, "_place": place}).sortWithinPartitions(*by, "_number", "_place")
    least = rows.mapInArrow(_leading(by, n), rows.schema).withColumn("_bucket", F.pmod(F.hash("_place"), F.lit(buckets)))
    for keys in ([*by, "_bucket"], by):
        order = Window.partitionBy(*keys).orderBy("_number", "_place")
        least = least.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= n)
    return least.select(*df.columns)
