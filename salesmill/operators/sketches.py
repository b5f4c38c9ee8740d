"""Distinct customers and price quantiles from small mergeable sketches, kept by month and region.

One pass makes, per month and region, a theta sketch of the customers and a KLL sketch of the prices: a few kB per group,
combined map-side, so a hot group costs one sketch per task. Questions over any months and regions merge sketches and
read no rows. Theta sketches also intersect, which counts distinct customers two months share.

Errors: an estimate of n distinct values strays by n / sqrt(2^LOG_ENTRIES) (1.6 %) in 68 of 100 cases and three times that
in 99.7; it is exact up to 2^LOG_ENTRIES values. That of an intersection strays by as much of the union. A price quantile
has a rank within RANK_ERROR of the one asked for in 99 of 100 cases, and is a given price.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from salesmill.sinks.monthly import MONTH, MonthlyTable

LOG_ENTRIES = 12
KLL_SIZE = 200
RANK_ERROR = 0.0165
GROUP = [MONTH, "region"]


def month_sketches(df: DataFrame) -> DataFrame:
    """AnioMes, region, rows, customers (theta), prices (KLL)."""
    # Theta sketches take no notice of empty text; a mark in front makes it a value like any other.
    customer = F.concat(F.lit("="), "customer_id")
    return df.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.theta_sketch_agg(customer, LOG_ENTRIES).alias("customers"),
        F.kll_sketch_agg_double("unit_price", KLL_SIZE).alias("prices"),
    )


def price_quantile(prices: Column, p: float) -> Column:
    """Quantile `p` of a KLL sketch; NULL without prices."""
    return F.when(F.kll_sketch_get_n_double(prices) > 0, F.kll_sketch_get_quantile_double(prices, F.lit(p)))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of groups `by`, which may be empty: of all."""
    return sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.theta_union_agg("customers", LOG_ENTRIES).alias("customers"),
        F.kll_merge_agg_double("prices", KLL_SIZE).alias("prices"),
    )


def figures(sketches: DataFrame, by: list[str], p: float = 0.95) -> DataFrame:
    """Rows, distinct customers and price quantile per group `by`."""
    return merged(sketches, by).select(
        *by, "n_rows", F.theta_sketch_estimate("customers").alias("n_customers"), price_quantile(F.col("prices"), p).alias("price")
    )


def kept_customers(sketches: DataFrame) -> DataFrame:
    """Per region and month: distinct customers, and how many of them bought in the month before as well."""
    # One row per month in each window.
    before = Window.partitionBy("region").orderBy(MONTH)
    month_no = lambda m: F.floor(F.col(m) / 100) * 12 + F.col(m) % 100
    rows = sketches.where(F.col(MONTH).isNotNull()).withColumns(
        {"last": F.lag("customers").over(before), "last_month": F.lag(MONTH).over(before)}
    )
    follows = month_no(MONTH) - month_no("last_month") == 1
    shared = F.when(follows, F.theta_sketch_estimate(F.theta_intersection("customers", "last"))).otherwise(F.lit(0))
    return rows.select(*GROUP, F.theta_sketch_estimate("customers").alias("n_customers"), shared.cast("long").alias("n_kept"))


class SketchStore:
    """Sketches by month, taken anew for the months that change."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = MonthlyTable(spark, path)

    def refresh(self, rows: DataFrame, months: Iterable[int] | None = None) -> list[int | None]:
        """Sketch whole months of `rows`: those named, or all it holds."""
        if months is not None:
            months = list(months)
            rows = rows.where(F.col(MONTH).isin(months))
        return self.table.replace(month_sketches(rows), months)

    def sketches(self, months: Iterable[int] | None = None) -> DataFrame:
        return self.table.read(months)
