"""Sinks. Every load is one Spark write; nothing is sliced into batches.

Replacing a table is safe: the new rows are complete before the table points to them. Overwriting a bare path is
not, since Spark deletes the old files first; write to a new path, or through a table, where readers must not notice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from salesmill.schemas import CLEAN_SCHEMA, conform
from salesmill.sources.gzip_members import write_members

PARTITION = "AnioMes"
# Rows of a gzip member: one to two MB of compressed extract, so that blocks of some MB hold several.
MEMBER_ROWS = 25_000


def write_parquet(df: DataFrame, path: str, schema: T.StructType | None = CLEAN_SCHEMA, by_month: bool = False, mode: str = "overwrite") -> None:
    """Typed load that replaces (or appends to) `path`.

    By month, rows are first rebalanced on it: each month goes to few files, and a month that holds a large
    part of the table is still split over many tasks.
    """
    out = conform(df, schema) if schema else df
    if by_month:
        out.hint("rebalance", PARTITION).write.mode(mode).partitionBy(PARTITION).parquet(path)
    else:
        out.write.mode(mode).parquet(path)


def create_or_replace_table(df: DataFrame, table: str, path: str) -> DataFrame:
    """Materialize a query as a catalog table over a new folder below `path`, replacing an earlier one.

    The rows are written first: if that fails, the old table stays as it is. A table with the same columns is then
    switched in one step; one with other columns is created anew. The folder of the old version is left to readers
    that still use it.
    """
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    columns = [(f.name, f.dataType) for f in df.schema]
    if spark.catalog.tableExists(table):
        if [(f.name, f.dataType) for f in spark.table(table).schema] == columns:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
            return spark.table(table)
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
    return spark.table(table)


def write_both(df: DataFrame, paths: list[str], schema: T.StructType | None = CLEAN_SCHEMA) -> None:
    """The same rows to several targets, computed once: the others are copied from the first."""
    first, *others = paths
    out = conform(df, schema) if schema else df
    out.write.mode("overwrite").parquet(first)
    copy = df.sparkSession.read.schema(out.schema).parquet(first)
    for path in others:
        copy.write.mode("overwrite").parquet(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may bring new columns; older files read them as NULL with `merge_schema`."""
    df.write.mode("append").parquet(path)


def merge_columns(*frames: DataFrame) -> DataFrame:
    """All rows of several inputs under the union of their columns."""
    first, *others = frames
    for df in others:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def add_column(spark: SparkSession, source: str, target: str, name: str, value: Column) -> DataFrame:
    """Add a column to a Parquet table by rewriting it to a new path; the source is never overwritten."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("target must differ from the path being read")
    spark.read.parquet(source).withColumn(name, value).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def text_rows(df: DataFrame) -> DataFrame:
    """Rows as unquoted comma-joined text, NULL as `None`."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in df.columns]
    return df.select(F.concat_ws(",", *cells).alias("value"))


def write_text(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Text load without header or quoting. `one_file` sends all rows through one task: small tables only."""
    rows = text_rows(df)
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, files: int | None = None, compression: str = "none") -> None:
    """CSV with header and quoting that `read_csv` reads back unchanged; gzip at its fastest level.

    With `members` as compression each gzip file is a chain of members, which `read_gzip_csv` splits.
    """
    out = df.repartition(files) if files else df
    if compression == "members":
        old = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        old.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(old, True)
        return write_members(out, path, MEMBER_ROWS, level=1)
    out.write.mode("overwrite").options(
        header=True, escape='"', compression=compression,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **{"zlib.compress.level": "BEST_SPEED"},
    ).csv(path)
