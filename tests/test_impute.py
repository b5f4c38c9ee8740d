"""Imputation: levels, NULL keys, the window form, and the join used when fills are too big to broadcast."""

import pytest
from pyspark.sql import Window, functions as F

from salesmill.operators import impute as imp
from salesmill.operators.clean import clean
from salesmill.plans.jobs import build_datamart
from salesmill.plans.profiles import PROFILES, Imputation

SCHEMA = "id int, AnioMes int, region string, product_id string, product_category string, unit_price double"
ROWS = [
    (1, 202301, "N", "a", "x", 10.0),
    (2, 202301, "N", "a", "x", None),   # mean of its product
    (3, 202301, "N", "b", "x", None),   # mean of its category
    (4, 202301, "N", "c", "y", None),   # mean of month and region
    (5, 202301, "S", "a", "x", None),   # mean over all
    (6, 202301, "N", "a", "x", 20.0),
    (7, 202302, "N", None, "x", 40.0),
    (8, 202302, "N", None, "z", None),  # a product group only where NULL is a key
    (9, None, "N", "a", "x", None),     # no month: mean over all, unless NULL is a key
]
ALL = 70.0 / 3


def result(df, spec, **kw):
    rows = imp.impute(df, spec, **kw).select("id", "unit_price_imput", "impute_level").collect()
    return {r.id: (r.unit_price_imput, r.impute_level) for r in rows}


@pytest.fixture(scope="module")
def prices(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_levels(prices):
    got = result(prices, PROFILES["datamart"].imputation)
    assert got == {
        1: (10.0, 0), 2: (15.0, 1), 3: (15.0, 2), 4: (15.0, 3), 5: (ALL, 4), 6: (20.0, 0), 7: (40.0, 0), 8: (40.0, 1), 9: (ALL, 4),
    }


def test_null_keys_match_nothing(prices):
    got = result(prices, PROFILES["external"].imputation)
    assert got[8] == (40.0, 3) and got[9] == (ALL, 4)
    assert got[1] == (None, 0), "present prices are not copied"


def test_month_alone_is_not_null_safe(prices):
    got = result(prices, PROFILES["chunked"].imputation)
    assert got[8] == (40.0, 1) and got[9] == (ALL, 4)


def test_one_level(prices):
    got = result(prices, PROFILES["lines"].imputation)
    assert got[2] == (15.0, 1) and got[3] == (None, None) and got[8] == (None, None)


def test_nothing_to_average(spark):
    df = spark.createDataFrame([(1, 202301, "N", "a", "x", None)], SCHEMA)
    assert result(df, Imputation()) == {1: (None, None)}


def test_zero_prices_and_blank_keys_stay_out_of_line_means(spark):
    rows = [(1, 202301, "N", "a", "x", 0.0), (2, 202301, "N", "a", "x", 8.0), (3, 202301, "N", "a", "x", None),
            (4, 202301, "", "a", "x", 5.0), (5, 202301, "", "a", "x", None)]
    got = result(spark.createDataFrame(rows, SCHEMA), PROFILES["lines"].imputation)
    assert got[3] == (8.0, 1) and got[5] == (None, None)


def test_shuffled_join_equals_broadcast(spark, monkeypatch):
    """One group holds a third of the missing rows; with a small HOT_SHARE it takes the hot path."""
    rows = spark.range(3000).select(
        F.col("id").cast("int").alias("id"),
        (202301 + F.col("id") % 5).cast("int").alias("AnioMes"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 7)).alias("region"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("p"), F.col("id") % 13)).alias("product_id"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("product_category"),
        F.when(F.col("id") % 4 != 1, F.col("id") % 17 + 0.25).alias("unit_price"),
    )
    for name in ("datamart", "external", "chunked"):
        spec = PROFILES[name].imputation
        want = result(rows, spec)
        for share in (1, 50, 1000):
            monkeypatch.setattr(imp, "HOT_SHARE", share)
            assert result(rows, spec, broadcast_bytes=0) == want
    assert len(want) == 3000


def test_window_form_agrees(raw):
    """The means as windows over all rows; only for a check, since a window gathers each group in one task."""
    rows = clean(raw, "datamart", "2001-08-01")
    mean = lambda *keys: F.avg("unit_price").over(Window.partitionBy(*keys))
    keys = imp.KEYS
    overall = rows.agg(F.avg("unit_price")).first()[0]
    windows = rows.withColumn(
        "by_window", F.coalesce("unit_price", mean(*keys[:3]), mean(keys[0], keys[1], keys[3]), mean(*keys[:2]), F.lit(overall))
    )
    both = imp.impute(windows, PROFILES["datamart"].imputation)
    off = both.where((F.abs(F.col("by_window") - F.col("unit_price_imput")) > 1e-6) | F.col("unit_price_imput").isNull())
    assert off.count() == 0 and both.count() == rows.count()


def test_unknown_ids_feed_the_means(raw):
    rows = clean(raw, "datamart", "2001-08-01")
    late = imp.impute(rows, PROFILES["datamart"].imputation).where("transaction_id != 'UNKNOWN'")
    built = build_datamart(raw, "datamart", "2001-08-01")
    total = lambda df: df.agg(F.round(F.sum("unit_price_imput"), 4)).first()[0]
    assert total(late) == total(built)
    assert built.where("transaction_id = 'UNKNOWN'").count() == 0


def test_no_row_is_shuffled_while_the_fills_are_small(raw):
    plan = build_datamart(raw, "datamart", "2001-08-01")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
