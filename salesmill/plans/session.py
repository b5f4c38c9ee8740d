"""Session settings the jobs want; each is left alone where the session already sets it."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # HotSpot does not compile methods above 8000 bytecodes. The cleaning projections are wide enough to pass
    # that in whole-stage code; with this limit Spark splits them into small compiled methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Dates carry no zone, so no result may depend on where it runs.
    "spark.sql.session.timeZone": "UTC",
    # Staged and landed text takes about two thirds of what it takes with the default codec.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    explicit = {row.key for row in spark.sql("SET").collect()}
    for key, value in SETTINGS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark
