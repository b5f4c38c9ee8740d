"""Headline queries, timed end to end; prints one JSON line.

BENCH_SF_DIR   folder of tables        (default /root/testdata/sf0.1)
BENCH_CPUS     local cores             (default 8)
BENCH_QUERIES  comma-separated names   (default: the list below)

`rows_per_min` is the throughput of the `datamart` job over an extract already landed as Parquet, which is
the work the published figures describe.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from salesmill import build_datamart
from salesmill.plans.catalog import AS_OF, QUERIES, landed, landed_lines

HEADLINE = [
    "datamart_clean", "external_clean", "chunked_clean", "microbatch_clean", "lines_clean",
    "impute_levels", "price_means_product", "stats_external", "eda_null_profile", "eda_monthly",
    "eda_segments", "eda_top_customers", "eda_price_hist", "quality_figures", "rejects", "bronze", "stream_append",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Do not look up the Python call site of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = session(cpus)
    landing = timed(lambda: landed(spark, sf_dir))
    lines = timed(lambda: landed_lines(spark, sf_dir))
    raw = landed(spark, sf_dir)
    n_rows = raw.count()
    run(raw)
    job = lambda: run(build_datamart(raw, "datamart", AS_OF))
    warm, best = timed(job), min(timed(job) for _ in range(3))
    seconds = {"landing": landing, "landing_lines": lines} | {name: timed(lambda: run(QUERIES[name](spark, sf_dir))) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows": n_rows,
                "datamart_first_run_sec": warm,
                "datamart_sec": best,
                "rows_per_min": round(n_rows / best * 60),
            }
        )
    )


if __name__ == "__main__":
    main()
