"""Results kept for a while: a question asked again over unchanged input is answered from the shared folder.

A result is kept under what it was computed from: the plan in Spark's canonical form, and the path, size and change time
of every input file. Another plan or a changed, added or removed file is another result; one older than the time to live
is computed again. Rows come back as they were, but in no particular order: sort after reading.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmill.plans.staging import shared_root

HOUR = 3600.0


def plan_key(df: DataFrame) -> str:
    """The same text for plans that give the same result from the same files."""
    spark = df.sparkSession
    fields = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", str(1 << 30))  # else long plans are cut short
    try:
        text = df._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    # The text lacks what Spark leaves out of plan strings (rows of local tables, options); the semantic hash has it.
    return f"{text}\n{df.semanticHash()}\n{df.schema.json()}"


def input_version(df: DataFrame) -> str:
    """Path, size and change time of all input files, as Spark lists them; no file is opened."""
    files = df.inputFiles()
    if not files:
        return "no files"
    listed = df.sparkSession.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
    row = listed.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    names = hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()
    return f"{names} {row[0]} {row[1]}"


class ResultCache:
    """`get(df)` gives the rows of `df`, computed at most once per `ttl` seconds while its input stays as it is.

    The caller is told with `hits` and `misses`. Plans whose result changes by itself (random numbers) are never kept.
    """

    def __init__(self, spark: SparkSession, ttl: float = HOUR, folder: str | None = None, clock: Callable[[], float] = time.time):
        self.spark, self.ttl, self.clock = spark, ttl, clock
        self.folder = (folder or f"{shared_root(spark)}/salesmill/results").rstrip("/")
        self.hits = self.misses = 0

    def get(self, df: DataFrame) -> DataFrame:
        if not df._jdf.queryExecution().analyzed().deterministic():
            self.misses += 1
            return df
        key = hashlib.sha256(f"{plan_key(df)}\n{input_version(df)}".encode()).hexdigest()
        path = self._kept(key)
        if path is None:
            self.misses += 1
            path = f"{self.folder}/{key}/made-{int(self.clock() * 1000):015d}"
            df.write.mode("overwrite").parquet(path)
            self._drop(key, path)
        else:
            self.hits += 1
        return self.spark.read.schema(df.schema).parquet(path)

    def _folders(self, key: str) -> list:
        """What has been kept under `key` and is complete, oldest first."""
        top = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{key}")
        system = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(top):
            return []
        found = [s.getPath() for s in system.listStatus(top)]
        done = lambda p: system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
        return sorted((p for p in found if done(p)), key=lambda p: p.getName())

    def _kept(self, key: str) -> str | None:
        for path in reversed(self._folders(key)):
            made = int(path.getName().removeprefix("made-")) / 1000
            return path.toString() if self.clock() - made < self.ttl else None
        return None

    def _drop(self, key: str, path: str) -> None:
        """Delete expired results of this key, but the last: a reader may still be at it."""
        name = path.rsplit("/", 1)[1]
        for old in [p for p in self._folders(key) if p.getName() < name][:-1]:
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
