"""Helpers shared by the training-data operators: reading tables, staging, bounded caches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: ASCII white space: words are the runs of everything else.
BLANKS = " \t\n\v\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, which all executors share; a local session without it gets a temporary one."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="salesmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A fresh path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def staged(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    df.write.parquet(path := new_folder(spark))
    return spark.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame, build: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, rows: int = 1000
) -> DataFrame:
    """`df` with each Arrow batch mapped, `rows` at a time; `build` runs once per task and returns the function of a batch."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = build()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield one(batch.slice(start, rows))

    return df.mapInArrow(task, schema)


def free_name(name: str, df: DataFrame) -> str:
    """`name`, with as many underscores behind it as it takes to be no column of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(column: pa.Array) -> list[str]:
    """The strings of a column, null as empty."""
    return [t or "" for t in column.to_pylist()]


class Recent(dict):
    """A memo of bounded size: `make(key)` fills it; the older of two generations goes when the younger one is full."""

    def __init__(self, make: Callable, size: int = 400_000):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def long_list(values, offsets) -> pa.ListArray:
    """A list<int64> column from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
