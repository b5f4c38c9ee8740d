"""No cell, however odd, ends a job; empty tables give empty answers."""

import pytest
from pyspark.sql import functions as F

from salesmill import build_datamart
from salesmill.functions import numeric
from salesmill.operators import dashboard, quality
from salesmill.operators import impute as imp
from salesmill.plans.profiles import PROFILES
from salesmill.schemas import CLEAN_SCHEMA, RAW_SCHEMA
from salesmill.sinks import tables
from salesmill.sources import files

from salesmill.plans.staging import new_path

GOOD = {"date": "2023-01-02", "timestamp": "2023-01-02 10:00:00", "product_id": "p", "region": "N", "unit_price": "5"}


def table(spark, rows):
    cells = [[{**GOOD, "transaction_id": f"t{i}", **row}.get(c) for c in RAW_SCHEMA.names] for i, row in enumerate(rows)]
    return spark.createDataFrame(cells, RAW_SCHEMA)


@pytest.mark.parametrize("profile", [p for p in PROFILES if p != "lines"])
def test_extreme_numbers(spark, profile):
    rows = [{"quantity": "1e30", "total_amount": "9e27"}, {"quantity": "9000000000000000000", "total_amount": "9e27"},
            {"quantity": "9000000000000000000", "unit_price": "9e27"}, {"total_amount": "1e37", "unit_price": "9e27"},
            {"unit_price": None}]
    mart = build_datamart(table(spark, rows), profile, "2023-01-03")
    assert mart.count() == 5
    if profile == "datamart":
        for query in [q for page in dashboard.PAGES.values() for q in page.values()]:
            query(mart).collect()
    if profile != "microbatch":  # which imputes nothing by itself
        assert mart.where(mart.transaction_id.like("%4")).first().unit_price_imput == pytest.approx((10 + 1.8e28) / 4)


def test_sums_beyond_decimals(spark):
    df = spark.createDataFrame([(1, 9e27), (1, 9e27), (2, 1.5), (2, None)], "k int, x double")
    sums = df.groupBy("k").agg(numeric.exact_sum(F.col("x")).alias("s"))
    assert dict(sums.collect()) == {1: 1.8e28, 2: 1.5}
    parts = df.groupBy("k").agg(*[c.alias(n) for n, c in numeric.sum_parts(F.col("x")).items()])
    merged = parts.agg(*[c.alias(n) for n, c in numeric.merge_parts().items()])
    assert merged.select(numeric.parts_mean()).first()[0] == pytest.approx(1.8e28 / 3)


def test_empty_table_and_zero_total(spark):
    nothing = spark.createDataFrame([], CLEAN_SCHEMA)
    for name, page in dashboard.PAGES.items():
        for query in page.values():
            query(nothing).collect()
    assert {r.pct for r in dashboard.null_profile(nothing).collect()} == {None}
    unpaid = spark.createDataFrame([("t", "x")], "transaction_id string, payment_method string")
    unpaid = tables.conform(unpaid, CLEAN_SCHEMA)
    assert [(r.revenue, r.share_pct) for r in dashboard.by_payment(unpaid).collect()] == [(0.0, None)]


def test_reject_reasons_follow_the_field_count(spark, tmp_path):
    cells = ["x"] * len(RAW_SCHEMA)
    lines = [cells, cells[:-2], [*cells, "y"], ['"a,""b"",c"', *cells[:-2]]]
    (tmp_path / "a.csv").write_text("\n".join(",".join(c) for c in lines) + "\n")
    good, bad = quality.split_corrupt(files.read_csv(spark, str(tmp_path), keep_corrupt=True, header=False))
    assert len(good.collect()) == 1
    assert sorted(r.reason for r in bad.collect()) == ["long_row", "short_row", "short_row"]


def test_replacing_keeps_the_old_table_on_failure(spark):
    path = new_path(spark, "replaced")
    name = "replaced_" + path.rsplit("-", 1)[1]
    tables.create_or_replace_table(spark.range(3), name, path)
    with pytest.raises(Exception):
        tables.create_or_replace_table(spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id")), name, path)
    assert spark.table(name).count() == 3
    assert tables.create_or_replace_table(spark.range(5), name, path).count() == 5
    assert tables.create_or_replace_table(spark.range(5).select("id", F.lit(1).alias("b")), name, path).columns == ["id", "b"]
    spark.sql(f"DROP TABLE {name}")


def test_large_fills_read_the_rows_once(spark, raw):
    from salesmill.operators.clean import clean

    rows = clean(raw, "datamart", "2001-08-01")
    plan = imp.impute(rows, PROFILES["datamart"].imputation, broadcast_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("notes#") and plan.count("Relation [") <= 3


def test_stream_takes_all_files_at_once(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(",".join(RAW_SCHEMA.names) + "\n" + ",".join(["x"] * len(RAW_SCHEMA)) + "\n")
    sizes = []
    query = files.stream_csv(spark, str(tmp_path)).writeStream.foreachBatch(lambda b, _: sizes.append(b.count()))
    query.option("checkpointLocation", new_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    assert [n for n in sizes if n] == [3]
