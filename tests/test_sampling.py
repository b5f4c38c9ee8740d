"""Samples by group: exact sizes, own rows, one read, no bias."""

import collections

import pytest
from pyspark.sql import functions as F

from salesmill.operators.sampling import sample_strata


def groups(spark):
    """One group with most rows, small ones, one of NULL keys, over several partitions."""
    key = F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 == 7, F.lit(None)).when(F.col("id") < 40, "small").otherwise(F.concat(F.lit("g"), F.col("id") % 3))
    return spark.range(20_000, numPartitions=7).withColumn("g", key)


@pytest.mark.parametrize("n", [1, 10, 100_000])
def test_exact_sizes(spark, n):
    rows = groups(spark)
    sizes = {r["g"]: r["count"] for r in rows.groupBy("g").count().collect()}
    got = sample_strata(rows, n, ["g"]).collect()
    assert collections.Counter(r["g"] for r in got) == {g: min(n, size) for g, size in sizes.items()}
    own = {r["id"]: r["g"] for r in rows.collect()}
    assert len({r["id"] for r in got}) == len(got) and all(own[r["id"]] == r["g"] for r in got)


def test_whole_table_and_repeatable(spark):
    rows = groups(spark)
    ids = lambda df: sorted(r["id"] for r in df.collect())
    first = ids(sample_strata(rows, 500, []))
    assert len(set(first)) == 500 and first == ids(sample_strata(rows, 500, [])) != ids(sample_strata(rows, 500, [], seed=8))
    assert sample_strata(rows, 500, []).columns == rows.columns
    assert sample_strata(rows.limit(0), 5, ["g"]).collect() == []


def test_every_row_is_as_likely(spark):
    """Over many seeds the ten parts of a table are drawn alike, also of equal rows."""
    rows = spark.range(1000, numPartitions=4).selectExpr("id div 100 part", "1 same")
    drawn = collections.Counter(r["part"] for seed in range(20) for r in sample_strata(rows, 100, ["same"], seed=seed).collect())
    assert drawn.total() == 2000 and all(140 <= drawn[p] <= 260 for p in range(10))


def test_input_is_read_once(spark, tmp_path):
    groups(spark).write.parquet(f"{tmp_path}/t")
    plan = sample_strata(spark.read.parquet(f"{tmp_path}/t"), 10, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
