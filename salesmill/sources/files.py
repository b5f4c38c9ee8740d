"""File and table sources. A missing path surfaces as Spark's own PATH_NOT_FOUND error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from salesmill.schemas import RAW_SCHEMA
from salesmill.sources.gzip_members import BLOCK_BYTES, gzip_lines, listed, readable
from salesmill.sources.records import parse_records, records, text_lines

CORRUPT = "_corrupt_record"

# Doubled quotes inside quoted fields, and no trimming that the cleaning does not do itself.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "mode": "PERMISSIVE",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def csv_schema(keep_corrupt: bool = False) -> T.StructType:
    if not keep_corrupt:
        return RAW_SCHEMA
    return T.StructType(RAW_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])


def read_csv(spark: SparkSession, path, quoted_newlines: bool = False, keep_corrupt: bool = False, header: bool = True) -> DataFrame:
    """CSV extract with the fixed all-text schema; short rows end in NULLs and extra fields are dropped.

    With `quoted_newlines` a record may span lines; files are still split (see `records`), at the price of a first
    pass over them, which runs right away. `keep_corrupt` adds the text of rows whose field count is wrong; the parser
    then reads all columns, since a pruned one could not be missed.
    """
    options = CSV_OPTIONS | {"header": header, "columnPruning": not keep_corrupt}
    if quoted_newlines:
        return parse_records(records(text_lines(spark, path), header), csv_schema(keep_corrupt), options)
    return spark.read.schema(csv_schema(keep_corrupt)).options(**options).csv(path)


def read_gzip_csv(spark: SparkSession, path, quoted_newlines: bool = False, keep_corrupt: bool = False, header: bool = True,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`read_csv` of gzip files that are split where their members start (see `gzip_members`).

    Spark's own reader takes over where every file fits in a block, and where workers cannot open the files at any byte.
    """
    found = listed(spark, path)
    if all(size <= block_bytes for _, size in found) or not readable(found):
        return read_csv(spark, path, quoted_newlines, keep_corrupt, header)
    lines, options = gzip_lines(spark, found, block_bytes), CSV_OPTIONS | {"columnPruning": not keep_corrupt}
    if quoted_newlines:
        rows = records(lines.drop("first"), header)
    else:
        text = F.rtrim(F.col("value").cast("string"), F.lit("\r"))
        rows = (lines.where(~F.col("first")) if header else lines).select(text.alias("value")).where("trim(value) <> ''")
    return parse_records(rows, csv_schema(keep_corrupt), options)


def _read_files(spark: SparkSession, source, quoted_newlines: bool, block_bytes: int) -> DataFrame:
    """The extract from paths or patterns; gzip files, where these end so, are split where they can be."""
    paths = [source] if isinstance(source, str) else source
    if all(p.endswith(".gz") for p in paths):
        return read_gzip_csv(spark, source, quoted_newlines, block_bytes=block_bytes)
    return read_csv(spark, source, quoted_newlines)


def external_view(spark: SparkSession, path, name: str = "raw_data", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The extract as a view over the files: quoted newlines and short rows are allowed, and nothing is copied but records that cross blocks.

    Gzip files are split where they can be.
    """
    df = _read_files(spark, path, True, block_bytes)
    df.createOrReplaceTempView(name)
    return df


def land_bronze(spark: SparkSession, source, target: str, quoted_newlines: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Copy a compressed extract to Parquet once, so that all later reads are split and pruned.

    Gzip files are split where they can be. Every task writes what it has read: no row moves, and Parquet is split
    whatever the size of its files.
    """
    _read_files(spark, source, quoted_newlines, block_bytes).write.mode("overwrite").parquet(target)
    return spark.read.schema(RAW_SCHEMA).parquet(target)


def read_table(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None, merge_schema: bool = False) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema else reader).parquet(name_or_path)


def stream_csv(spark: SparkSession, path: str, files_per_trigger: int | None = None, keep_corrupt: bool = False, header: bool = True) -> DataFrame:
    """The same extract as a stream of files; a micro-batch takes all files there are unless told otherwise.

    Of a few files, which compressed ones are read by as few tasks, the rows are dealt over all cores.
    """
    reader = spark.readStream.schema(csv_schema(keep_corrupt)).options(**CSV_OPTIONS).options(header=header, columnPruning=not keep_corrupt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.csv(path)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if files_per_trigger and files_per_trigger < cores else rows
