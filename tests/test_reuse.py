"""Kept results: read again without their source, computed again when they expire or the input changes."""

import pytest
from pyspark.sql import functions as F

from salesmill.operators import dashboard
from salesmill.plans.reuse import ResultCache, plan_key
from salesmill.plans.staging import new_path


class Clock:
    now = 1000.0

    def __call__(self):
        return self.now


@pytest.fixture
def cache(spark):
    return ResultCache(spark, ttl=60, folder=new_path(spark, "results"), clock=Clock())


def counted(spark, path):
    return spark.read.schema("a long, b string").parquet(path).where("a > 1").groupBy("b").agg(F.count(F.lit(1)).alias("n"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_reuse_expiry_and_changes(spark, cache):
    path = new_path(spark, "source")
    spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "a long, b string").coalesce(1).write.parquet(path)
    first = cache.get(counted(spark, path))
    again = cache.get(counted(spark, path))  # another DataFrame with the same meaning
    assert (cache.hits, cache.misses) == (1, 1) and rows(first) == rows(again) == [("x", 1), ("y", 1)]
    assert again.inputFiles() and all(path not in f for f in again.inputFiles()), "the source is not read"
    cache.clock.now += 61
    assert rows(cache.get(counted(spark, path))) == [("x", 1), ("y", 1)] and cache.misses == 2, "expired"
    assert rows(first) == [("x", 1), ("y", 1)], "an earlier reader goes on"
    cache.get(counted(spark, path))
    assert cache.hits == 2
    spark.createDataFrame([(9, "z")], "a long, b string").write.mode("append").parquet(path)
    assert rows(cache.get(counted(spark, path))) == [("x", 1), ("y", 1), ("z", 1)] and cache.misses == 3, "changed input"
    spark.createDataFrame([(9, "w")], "a long, b string").coalesce(1).write.mode("overwrite").parquet(path)
    assert rows(cache.get(counted(spark, path))) == [("w", 1)]


def test_other_plans_are_other_results(spark, cache):
    path = new_path(spark, "source")
    spark.range(100).selectExpr("id a", *[f"id + {i} c{i}" for i in range(60)]).write.parquet(path)
    wide = lambda i: spark.read.parquet(path).select("a", *[f"c{j}" for j in range(59)], F.col(f"c{i}").alias("last"))
    assert plan_key(wide(58)) != plan_key(wide(59)) and plan_key(wide(58)) == plan_key(wide(58))
    assert rows(cache.get(wide(58))) != rows(cache.get(wide(59)))
    local = lambda v: spark.createDataFrame([(v,)], "v long")
    assert [rows(cache.get(local(v))) for v in (1, 2, 1)] == [[(1,)], [(2,)], [(1,)]]
    before = cache.misses
    cache.get(spark.range(3).withColumn("r", F.rand()))
    cache.get(spark.range(3).withColumn("r", F.rand()))
    assert cache.misses == before + 2, "random results are not kept"


def test_an_unfinished_result_is_not_used(spark, cache):
    bad = lambda fail: spark.range(10).select(F.when(F.lit(fail) & (F.col("id") == 7), F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("v"))
    with pytest.raises(Exception, match="stop"):
        cache.get(bad(True))
    with pytest.raises(Exception, match="stop"):
        cache.get(bad(True))
    assert rows(cache.get(bad(False))) == [(i,) for i in range(10)]


def test_dashboard_pages_from_kept_results(spark, raw, cache):
    from salesmill.operators.clean import clean, finish

    mart = finish(clean(raw, "datamart", "2001-08-01"), "datamart")
    want = rows(dashboard.monthly(mart))
    assert rows(cache.get(dashboard.monthly(mart))) == want == rows(cache.get(dashboard.monthly(mart)))
    assert (cache.hits, cache.misses) == (1, 1)
