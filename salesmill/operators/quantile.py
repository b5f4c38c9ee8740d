"""An exact quantile that never gathers the values in one place.

`percentile` merges a map of all distinct values in one task. Here the values are counted, then cut into
slices at sketch quantiles; the slice that holds the wanted rank is kept and cut again, until the values
left are few enough to rank directly. Only the weights of the slices come to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmill.plans.staging import stage

RANKED_VALUES = 100_000
SLICES = 256


def exact_quantile(df: DataFrame, column: str, p: float, name: str = "q", ranked_values: int = RANKED_VALUES) -> DataFrame:
    """One row: quantile `p` of `column`, linearly interpolated between two values; NULL without values."""
    return quantile_of(value_counts(df, column), p, name, ranked_values)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Staged: every value `v` of `column` but NULL, and the number `w` of rows that hold it."""
    given = df.where(F.col(column).isNotNull())
    return stage(given.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("w")), "value-counts")


def quantile_of(counts: DataFrame, p: float, name: str = "q", ranked_values: int = RANKED_VALUES) -> DataFrame:
    """`exact_quantile` over staged `value_counts`."""
    n = counts.agg(F.sum("w")).first()[0] or 0
    rank = p * max(n - 1, 0)
    near, below = _narrow(counts, rank, ranked_values)
    # `near` holds at most `ranked_values` values, which bounds what the one window task sees.
    so_far = F.sum("w").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = near.select("v", so_far.alias("seen"))
    low, high = [F.min(F.when(F.col("seen") > k - below, F.col("v"))) for k in (math.floor(rank), math.ceil(rank))]
    return ranked.agg((low + (high - low) * F.lit(rank - math.floor(rank))).alias(name))


def _narrow(counts: DataFrame, rank: float, ranked_values: int) -> tuple[DataFrame, int]:
    """The distinct values around `rank`, few enough to rank, and how many rows lie below them all."""
    near, below = counts, 0
    while near.count() > ranked_values:
        points = [i / SLICES for i in range(1, SLICES)]
        cuts = sorted(set(near.agg(F.percentile_approx("v", points, 10 * SLICES)).first()[0]))
        slice_no = _slice_no(cuts)
        weights = sorted(near.groupBy(slice_no.alias("s")).agg(F.sum("w")).collect())
        first, before = _slice_at(weights, math.floor(rank) - below)
        last, _ = _slice_at(weights, math.ceil(rank) - below)
        below += before
        near = near.where(slice_no.between(first, last))
    return near, below


def _slice_no(cuts: list[float]) -> Column:
    """How many cuts lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < F.col("v")))


def _slice_at(weights: list, k: int) -> tuple[int, int]:
    """Slice that holds row `k`, and the number of rows before it."""
    before = 0
    for s, w in weights:
        if k < before + w:
            return s, before
        before += w
    raise ValueError("rank beyond the last row")
