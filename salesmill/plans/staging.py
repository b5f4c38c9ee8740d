"""Intermediate tables in the shared checkpoint folder: they cut lineage and outlive lost executors."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="salesmill-")


def shared_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a private one only for a local session without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local["):
        return _local_root()
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/salesmill/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as Parquet and go on from the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row, with slack for the hash-table entry that will hold it."""
    size = F.lit(32 + 16 * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
    return size
