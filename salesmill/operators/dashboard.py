"""The dashboard's questions, each a DataFrame over the clean table.

NULL keys are left out of the groups and the sum of no values is zero, as the dashboard shows them.
Ordered results carry the key as a tie-break.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from salesmill.functions.dates import window_start, year_month
from salesmill.functions.numeric import exact_avg, exact_sum, round_money
from salesmill.operators.clean import as_of_column
from salesmill.operators.quantile import exact_quantile, quantile_of, value_counts
from salesmill.operators.stats import table_stats
from salesmill.plans.reuse import ResultCache
from salesmill.plans.staging import stage


def _revenue() -> Column:
    return round_money(F.coalesce(exact_sum(F.col("total_amount")), F.lit(0.0))).alias("revenue")


def _quantity() -> Column:
    """NULL only where the sum fits no bigint."""
    return F.when(F.count("quantity") == 0, F.lit(0).cast("long")).otherwise(F.try_sum("quantity")).alias("quantity")


def _transactions() -> Column:
    return F.count("transaction_id").alias("transactions")


def _by(df: DataFrame, key: str, *measures: Column) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*measures)


def _share(groups: DataFrame, measure: str) -> DataFrame:
    """Add the part each group has in the total of `measure`, in percent; NULL where the total is zero.

    The total comes from the staged groups, a handful of rows, so the table is read once.
    """
    staged = stage(groups, "groups")
    total = staged.agg(exact_sum(F.col(measure).cast("double")).alias("t")).scalar()
    return staged.withColumn("share_pct", F.try_divide(F.col(measure).cast("double"), total) * 100)


def _ranked(groups: DataFrame, measure: str = "revenue") -> DataFrame:
    return groups.orderBy(F.col(measure).desc(), groups.columns[0])


def kpis(df: DataFrame) -> DataFrame:
    return table_stats(df, "dashboard")


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, counted in one pass and turned into rows."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = counted.unpivot("n_rows", df.columns, "column", "nulls")
    return rows.select("column", "nulls", (F.try_divide("nulls", "n_rows") * 100).alias("pct")).orderBy(
        F.col("nulls").desc(), "column"
    )


def column_types(df: DataFrame) -> DataFrame:
    """Every column with its type and how many values it holds."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = counted.unpivot([], df.columns, "column", "n_values")
    return rows.select("column", types[F.col("column")].alias("type"), "n_values")


def by_region(df: DataFrame) -> DataFrame:
    return _ranked(_share(_by(df, "region", F.count(F.lit(1)).alias("transactions")), "transactions"), "transactions")


def monthly(df: DataFrame) -> DataFrame:
    """Per month: revenue, mean ticket, transactions with an amount, quantity, distinct customers."""
    months = df.where(F.col("date").isNotNull()).groupBy(year_month(F.col("date")).alias("year_month"))
    return months.agg(
        _revenue(),
        round_money(exact_avg(F.col("total_amount"))).alias("avg_amount"),
        F.count("total_amount").alias("transactions"),
        _quantity(),
        F.count_distinct("customer_id").alias("customers"),
    ).orderBy("year_month")


def by_category(df: DataFrame) -> DataFrame:
    return _ranked(_by(df, "product_category", _revenue(), _quantity(), _transactions()))


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    return _ranked(_by(df, "product_id", _revenue(), _quantity(), _transactions())).limit(n)


def by_lifecycle(df: DataFrame) -> DataFrame:
    return _ranked(_share(_by(df, "product_lifecycle", _revenue(), _quantity(), _transactions()), "revenue"))


def by_segment(df: DataFrame) -> DataFrame:
    customers = F.count_distinct("customer_id").alias("customers")
    return _ranked(_by(df, "customer_segment", _revenue(), _quantity(), _transactions(), customers))


def top_customers(df: DataFrame, n: int = 10) -> DataFrame:
    return _ranked(_by(df, "customer_id", _revenue(), _quantity(), _transactions())).limit(n)


def by_payment(df: DataFrame) -> DataFrame:
    return _ranked(_share(_by(df, "payment_method", _revenue(), _transactions()), "revenue"))


def financial(df: DataFrame) -> DataFrame:
    total = lambda c: F.coalesce(exact_sum(F.col(c)), F.lit(0.0))
    return df.agg(
        total("total_amount").alias("revenue"),
        exact_avg(F.col("total_amount")).alias("avg_ticket"),
        total("discount_pct").alias("discount_sum"),
        total("tax_amount").alias("tax_sum"),
    )


def histogram(counts: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins between the least and the greatest of `value_counts`; empty bins are left out."""
    lo, hi = counts.agg(F.min("v"), F.max("v")).first()
    if lo is None:
        lo = hi = 0.0
    width = (hi - lo) / bins or 1.0
    bin_no = F.least(F.floor((F.col("v") - lo) / width).cast("int"), F.lit(bins - 1))
    counted = counts.groupBy(bin_no.alias("bin")).agg(F.sum("w").alias("n"))
    return counted.select(
        "bin", (F.lit(lo) + F.col("bin") * width).alias("bin_from"), "n"
    ).orderBy("bin")


def price_p95(df: DataFrame) -> DataFrame:
    return exact_quantile(df, "unit_price", 0.95, "p95")


def price_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Histogram of unit prices; `in_view` marks the bins that start at or below the 95th percentile.

    Both come from the staged value counts: the rows are read once.
    """
    counts = value_counts(df, "unit_price")
    p95 = quantile_of(counts, 0.95).first()[0]
    return histogram(counts, bins).withColumn("in_view", F.col("bin_from") <= F.lit(p95))


def discount_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(value_counts(df, "discount_pct"), bins)


def price_by_region(df: DataFrame) -> DataFrame:
    return _ranked(_by(df, "region", exact_avg(F.col("unit_price")).alias("avg_price")), "avg_price")


def discount_by_category(df: DataFrame) -> DataFrame:
    return _ranked(_by(df, "product_category", exact_avg(F.col("discount_pct")).alias("avg_discount")), "avg_discount")


def region_profit(df: DataFrame) -> DataFrame:
    return _ranked(_by(df, "region", _revenue(), _quantity(), _transactions()))


def recent(df: DataFrame, as_of=None, days: int = 60) -> DataFrame:
    """Rows of the last `days` days; on a table partitioned by month, Spark prunes with the second test."""
    start = window_start(as_of_column(as_of), days)
    return df.where(F.col("date") >= start).where(F.col("AnioMes") >= F.year(start) * 100 + F.month(start))


PAGES: dict[str, dict[str, Callable[[DataFrame], DataFrame]]] = {
    "general": {"kpis": kpis, "null_profile": null_profile, "column_types": column_types, "by_region": by_region},
    "temporal": {"monthly": monthly},
    "products": {"by_category": by_category, "top_products": top_products, "by_lifecycle": by_lifecycle},
    "customers": {"by_segment": by_segment, "top_customers": top_customers, "by_payment": by_payment},
    "financial": {
        "financial": financial, "price_histogram": price_histogram, "price_by_region": price_by_region,
        "discount_histogram": discount_histogram, "discount_by_category": discount_by_category,
        "region_profit": region_profit,
    },
}


def page(df: DataFrame, name: str, cache: ResultCache | None = None) -> dict[str, DataFrame]:
    """All results of one dashboard page, from `cache` where one is given.

    Without one, `persist` the table first when showing more than one of them.
    """
    results = {title: query(df) for title, query in PAGES[name].items()}
    return {title: cache.get(result) for title, result in results.items()} if cache else results
