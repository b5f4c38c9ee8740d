"""Hierarchical mean imputation of `unit_price`.

The price of a row that has none is the mean over (month, region, product), else over (month, region,
category), else over (month, region), else over the whole table.

The table is aggregated once, on all four keys, into mergeable sums (map-side combined, so a hot group
costs one partial row per task). That small table is staged, rolled up to the coarser levels, and the
levels are resolved *there*: every key combination that misses a price gets its final fill value. The big
side then needs a single lookup join instead of one per level, and is never shuffled while the resolved
table is small enough to broadcast, which is measured, not assumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from salesmill.functions.numeric import merge_parts, parts_mean, sum_parts
from salesmill.operators.clean import PRICE_MISSING
from salesmill.plans.profiles import Imputation
from salesmill.plans.staging import row_bytes, stage

KEYS = ["AnioMes", "region", "product_id", "product_category"]
LEVEL_KEYS = {
    1: ["AnioMes", "region", "product_id"],
    2: ["AnioMes", "region", "product_category"],
    3: ["AnioMes", "region"],
}
FILLED = ["fill_price", "fill_level"]
BROADCAST_BYTES = 64 << 20
# A group with more than one in HOT_SHARE of all missing rows is hot, so fewer than HOT_SHARE groups are.
HOT_SHARE = 1000


def missing_price(df: DataFrame) -> Column:
    return F.col(PRICE_MISSING) if PRICE_MISSING in df.columns else F.col("unit_price").isNull()


def _blank_free(spec: Imputation, keys: list[str]) -> Column:
    """Rows whose keys may form a group under `spec`."""
    ok = F.lit(True)
    for k in keys:
        if k not in spec.null_safe:
            ok = ok & F.col(k).isNotNull()
        if spec.skip_blank:
            ok = ok & (F.col(k) != (F.lit(0) if k == "AnioMes" else F.lit("")))
    return ok


def price_groups(df: DataFrame, spec: Imputation = Imputation(), keys: list[str] = KEYS) -> DataFrame:
    """Mergeable price sums and the number of fillable rows per key combination."""
    price = F.col("unit_price")
    if spec.skip_blank:
        price = F.when(price != 0, price)
    sums = [c.alias(n) for n, c in sum_parts(price).items()]
    return df.groupBy(*keys).agg(*sums, F.count_if(missing_price(df)).alias("n_missing"))


def level_means(groups: DataFrame, level: int, spec: Imputation = Imputation(), name: str = "mean_price") -> DataFrame:
    """Mean price per key of `level` (1-3), merged from `price_groups`; groups without any price are left out."""
    keys = LEVEL_KEYS[level]
    merged = groups.where(_blank_free(spec, keys)).groupBy(*keys).agg(*[c.alias(n) for n, c in merge_parts().items()])
    return merged.select(*keys, parts_mean().alias(name)).where(F.col(name).isNotNull())


def global_mean(groups: DataFrame, name: str = "mean_price") -> DataFrame:
    """One row: the mean over all prices."""
    return groups.agg(*[c.alias(n) for n, c in merge_parts().items()]).select(parts_mean().alias(name))


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str], null_safe) -> Column:
    on = F.lit(True)
    for k in keys:
        a, b = left[k], right[f"r_{k}"]
        on = on & (a.eqNullSafe(b) if k in null_safe else a == b)
    return on


def _lookup(left: DataFrame, right: DataFrame, keys: list[str], null_safe, how: str = "left") -> DataFrame:
    right = right.withColumnsRenamed({k: f"r_{k}" for k in keys})
    return left.join(right, _same_keys(left, right, keys, null_safe), how).drop(*[f"r_{k}" for k in keys])


def fill_table(groups: DataFrame, spec: Imputation = Imputation(), overall: DataFrame | None = None) -> DataFrame:
    """For every key combination with a missing price: `fill_price` and the `fill_level` (1-4) it came from.

    `overall`: the groups of the whole table, where `groups` holds some of its months only.
    """
    fills = groups.where("n_missing > 0").select(*KEYS, "n_missing")
    levels = range(1, min(spec.levels, 3) + 1)
    for level in levels:
        fills = _lookup(fills, level_means(groups, level, spec, f"mean_{level}"), LEVEL_KEYS[level], spec.null_safe)
    means = {level: F.col(f"mean_{level}") for level in levels}
    if spec.levels == 4:
        means[4] = F.col("mean_4")
        fills = fills.withColumn("mean_4", global_mean(groups if overall is None else overall).scalar())
    reached = [F.when(m.isNotNull(), F.lit(level)) for level, m in means.items()]
    return fills.select(
        *KEYS,
        "n_missing",
        F.coalesce(*means.values()).alias("fill_price"),
        F.coalesce(*reached).alias("fill_level"),
    )


@dataclass(frozen=True)
class Fills:
    """Resolved, staged fill values and the measured facts that decide how to join them."""

    table: DataFrame
    n_missing: int
    n_bytes: int


def prepare_fills(df: DataFrame, spec: Imputation = Imputation()) -> Fills:
    """Aggregate `df` once, stage the group sums and the fills they resolve to, and measure the latter."""
    groups = stage(price_groups(df, spec), "price-groups")
    return measure_fills(stage(fill_table(groups, spec), "fills"))


def measure_fills(fills: DataFrame) -> Fills:
    """A staged `fill_table` with its size."""
    size = fills.agg(F.sum("n_missing"), F.sum(row_bytes(fills))).first()
    return Fills(fills, size[0] or 0, size[1] or 0)


def _filled(df: DataFrame, spec: Imputation) -> DataFrame:
    price, missing = F.col("unit_price"), missing_price(df)
    filled = F.when(missing, F.col("fill_price"))
    if not spec.only_missing:
        filled = F.when(missing, F.col("fill_price")).otherwise(price)
    level = F.when(~missing, F.lit(0)).otherwise(F.col("fill_level"))
    return df.withColumns({"unit_price_imput": filled, "impute_level": level}).drop("fill_price", "fill_level")


def apply_fills(df: DataFrame, fills: Fills, spec: Imputation = Imputation(), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add `unit_price_imput` and `impute_level` by looking every row's key combination up in `fills`.

    Up to `broadcast_bytes` the fills are broadcast and `df` stays where it is. Beyond that hot combinations,
    of which there are fewer than HOT_SHARE whatever the data, are broadcast first, and one shuffle join
    looks up what is still open. Rows that need nothing from it carry a hash of their own as the key: no key
    holds more than one in HOT_SHARE of the open rows, and `df` is read once.
    """
    table = fills.table.drop("n_missing")
    if fills.n_bytes <= broadcast_bytes:
        return _filled(_lookup(df, F.broadcast(table), KEYS, KEYS), spec)
    is_hot = F.col("n_missing") * HOT_SHARE > fills.n_missing
    hot = F.broadcast(fills.table.where(is_hot).select(*KEYS, *[F.col(c).alias(f"hot_{c}") for c in FILLED], F.lit(True).alias("is_hot")))
    cold = fills.table.where(~is_hot).drop("n_missing").withColumn("own", F.lit(0).cast("long"))
    rows = _lookup(df, hot, KEYS, KEYS)
    is_open = missing_price(df) & F.col("is_hot").isNull()
    # xxhash64 with the lowest bit set is never the 0 of the open rows.
    own = F.when(is_open, F.lit(0).cast("long")).otherwise(F.xxhash64(*df.columns).bitwiseOR(F.lit(1).cast("long")))
    keyed = rows.withColumns({"own": own, **{f"open_{k}": F.when(is_open, F.col(k)) for k in KEYS}})
    cold = cold.withColumnsRenamed({k: f"r_{k}" for k in [*KEYS, "own"]})
    on = keyed["own"] == cold["r_own"]
    for k in KEYS:
        on = on & keyed[f"open_{k}"].eqNullSafe(cold[f"r_{k}"])
    joined = keyed.join(cold, on, "left")
    return _filled(joined.select(*df.columns, *[F.coalesce(f"hot_{c}", c).alias(c) for c in FILLED]), spec)


def impute(df: DataFrame, spec: Imputation = Imputation(), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Fill missing prices of `df` from its own group means."""
    return apply_fills(df, prepare_fills(df, spec), spec, broadcast_bytes)
