"""Stored sketches against exact figures, and exact distinct counts without expanding the rows."""

from pyspark.sql import functions as F

from salesmill.operators import sketches
from salesmill.operators.stats import table_stats
from salesmill.plans.staging import new_path, stage

KIND = "AnioMes int, region string, customer_id string, unit_price double"


def sales(spark, n=200_000):
    """Many customers, half of them in both months; one region holds most rows."""
    return spark.range(n).selectExpr(
        "if(id % 2 = 0, 200012, 200101) AnioMes", "if(id % 10 < 8, 'big', 'small') region",
        "cast(if(id % 4 < 2, id div 2, id) as string) customer_id", "if(id % 100 = 0, null, cast((id * 7919) % 10007 as double)) unit_price",
    )


def test_errors_stay_in_their_bounds(spark):
    rows = stage(sales(spark), "sales")
    held = stage(sketches.month_sketches(rows), "sketches")
    bound = 3 / 2 ** (sketches.LOG_ENTRIES / 2)
    for by in (["region"], sketches.GROUP, []):
        exact = {tuple(r)[: len(by)]: r for r in rows.groupBy(*by).agg(F.count_distinct("customer_id").alias("n"), F.collect_list("unit_price").alias("p")).collect()}
        for r in sketches.figures(held, by).collect():
            want = exact[tuple(r)[: len(by)]]
            assert abs(r["n_customers"] - want["n"]) <= bound * want["n"]
            below = sum(p < r["price"] for p in want["p"]) / len(want["p"])
            upto = sum(p <= r["price"] for p in want["p"]) / len(want["p"])
            assert below - sketches.RANK_ERROR <= 0.95 <= upto + sketches.RANK_ERROR and r["price"] in set(want["p"])
    both = rows.groupBy("region", "customer_id").agg(F.count_distinct("AnioMes").alias("m")).where("m = 2").groupBy("region").count()
    kept = {r["region"]: r for r in sketches.kept_customers(held).where("AnioMes = 200101").collect()}
    union = {r["region"]: r["n"] for r in rows.groupBy("region").agg(F.count_distinct("customer_id").alias("n")).collect()}
    for r in both.collect():
        assert abs(kept[r["region"]]["n_kept"] - r["count"]) <= bound * union[r["region"]]


def test_small_groups_are_exact(spark):
    rows = spark.createDataFrame(
        [(200012, "r", "a", 1.0), (200012, "r", "", None), (200012, "r", None, None), (200101, "r", "a", None), (200101, "r", "", 5.0),
         (200103, "r", "a", 2.0), (200101, None, None, None), (None, "r", "z", 3.0)], KIND
    )
    store = sketches.SketchStore(spark, new_path(spark, "sketches"))
    store.refresh(rows)
    by_month = {(r["AnioMes"], r["region"]): (r["n_rows"], r["n_customers"], r["price"]) for r in sketches.figures(store.sketches(), sketches.GROUP).collect()}
    assert by_month == {
        (200012, "r"): (3, 2, 1.0), (200101, "r"): (2, 2, 5.0), (200103, "r"): (1, 1, 2.0), (200101, None): (1, 0, None), (None, "r"): (1, 1, 3.0),
    }
    kept = {(r["AnioMes"], r["region"]): r["n_kept"] for r in sketches.kept_customers(store.sketches()).collect()}
    assert kept == {(200012, "r"): 0, (200101, "r"): 2, (200103, "r"): 0, (200101, None): 0}  # February has no rows
    assert store.refresh(rows.where("customer_id = 'a'"), [200101]) == [200101]
    assert sketches.figures(store.sketches([200101]), []).first()["n_customers"] == 1
    assert sketches.figures(store.sketches(), []).first()["n_customers"] == 3
    assert sketches.figures(sketches.month_sketches(rows.limit(0)), ["region"]).collect() == []


def test_distinct_counts_do_not_expand_rows(spark):
    rows = sales(spark, 1000).withColumns({"product_id": F.col("customer_id"), "quantity": F.lit(1), "total_amount": F.lit(2.0), "date": F.current_date()})
    stats = table_stats(rows, "external")
    assert "Expand" not in stats._jdf.queryExecution().executedPlan().toString()
    want = rows.agg(F.count_distinct("customer_id"), F.count_distinct("region")).first()
    assert (stats.first()["unique_customers"], stats.first()["unique_regions"]) == tuple(want)
    assert stats.columns[:4] == ["total_rows", "unique_customers", "unique_products", "unique_regions"]
    close = table_stats(rows, "external", rsd=0.02).first()
    assert abs(close["unique_customers"] - want[0]) <= 0.1 * want[0]
    assert table_stats(rows.limit(0), "short").first()["clientes_unicos"] == 0
