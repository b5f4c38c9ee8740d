"""One-row summaries of the clean table.

Sums and means of money go through `exact_sum`, so a figure does not change with the order of the rows or
with a retried task. Distinct counts are exact by default: each is counted in two steps over its own column, since
several of them in one aggregate make Spark expand its input. `rsd` offers sketches of that relative error in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmill.functions.numeric import exact_avg, exact_sum


class Distinct(str):
    """A column whose distinct values are counted."""


def _counts(rows: str) -> dict[str, Column | Distinct]:
    return {
        rows: F.count(F.lit(1)),
        "unique_customers": Distinct("customer_id"),
        "unique_products": Distinct("product_id"),
        "unique_regions": Distinct("region"),
        "earliest_date": F.min("date"),
        "latest_date": F.max("date"),
    }


def _flavours() -> dict[str, dict[str, Column | Distinct]]:
    price, amount, quantity = F.col("unit_price"), F.col("total_amount"), F.col("quantity")
    money = {
        "avg_unit_price": exact_avg(price),
        "avg_total_amount": exact_avg(amount),
        "total_revenue": exact_sum(amount),
    }
    wide = {"avg_quantity": F.avg(quantity), **money}
    return {
        "external": {
            **_counts("total_rows"),
            **money,
            "null_prices": F.count_if(price.isNull()),
            "null_quantities": F.count_if(quantity.isNull()),
        },
        "pipeline": {**_counts("total_rows"), **wide},
        "dashboard": {**_counts("total_transactions"), **wide},
        # The Spanish column names of the short report.
        "short": {
            "total_registros": F.count(F.lit(1)),
            "clientes_unicos": Distinct("customer_id"),
            "productos_unicos": Distinct("product_id"),
            "regiones": Distinct("region"),
            "fecha_inicio": F.min("date"),
            "fecha_fin": F.max("date"),
            "monto_promedio": exact_avg(amount),
            "monto_total": exact_sum(amount),
        },
        "smoke": {"total_rows": F.count(F.lit(1)), "avg_price": exact_avg(price)},
        "count": {"total": F.count(F.lit(1))},
    }


def distinct_values(df: DataFrame, column: str) -> Column:
    """How many values but NULL `column` has: a scalar, from an aggregate that reads no other column and combines map-side."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.lit(1).alias("one")).agg(F.count(F.lit(1))).scalar()


def table_stats(df: DataFrame, flavour: str = "external", rsd: float | None = None) -> DataFrame:
    """One row of statistics: "external", "pipeline", "dashboard", "short", "smoke" or "count"."""
    flavours = _flavours()
    if flavour not in flavours:
        raise ValueError(f"unknown statistics {flavour!r}; known: {', '.join(flavours)}")
    wanted = flavours[flavour]
    sketched = {n: F.approx_count_distinct(c, rsd) for n, c in wanted.items() if rsd is not None and isinstance(c, Distinct)}
    one = df.agg(*[c.alias(n) for n, c in {**wanted, **sketched}.items() if isinstance(c, Column)])
    counted = {n: distinct_values(df, c) for n, c in wanted.items() if isinstance(c, Distinct) and rsd is None}
    return one.withColumns(counted).select(*wanted) if counted else one
