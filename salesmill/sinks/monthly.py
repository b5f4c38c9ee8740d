"""A Parquet table kept in versioned month folders, changed month by month.

New months are written to a folder of their own; then one small manifest row per month says which folder holds it. A
reader takes the last manifest, so it sees a change whole or not at all, and a write that fails before the manifest
leaves the table as it was. Only the months that change are read and written. A manifest never changes, so each is read
once, and looking for a newer one opens no file. One writer at a time: a second one that takes the same version fails. Older folders serve readers that still use them until `expire`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MONTH = "AnioMes"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
MANIFEST = "AnioMes int, folder string, schema string, mark long"
MANIFEST_ARROW = pa.schema([("AnioMes", pa.int32()), ("folder", pa.string()), ("schema", pa.string()), ("mark", pa.int64())])


class MonthlyTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._known: dict[int, list] = {}

    # -- versions -----------------------------------------------------------------------------------------------

    def _hadoop(self, path: str):
        """A Hadoop path and its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifests(self) -> dict[int, list]:
        """The rows of every manifest by version; they are read again only where there is a newer one."""
        path, system = self._hadoop(f"{self.path}/manifest/version={max(self._known, default=0) + 1}")
        if system.exists(path):
            rows = self.spark.read.schema(f"{MANIFEST}, version int").parquet(f"{self.path}/manifest")
            newer = rows.where(F.col("version") > max(self._known, default=0)).collect()
            for row in newer:
                self._known.setdefault(row["version"], []).append(row)
        return self._known

    def version(self, before: int | None = None) -> int | None:
        """The last version, or the last one with a mark below `before`."""
        marks = {v: rows[0]["mark"] for v, rows in self._manifests().items()}
        return max((v for v, mark in marks.items() if before is None or mark is not None and mark < before), default=None)

    def mark(self) -> int | None:
        """The highest mark of any version."""
        return max((rows[0]["mark"] for rows in self._manifests().values() if rows[0]["mark"] is not None), default=None)

    def _entries(self, version: int | None) -> list:
        if version is None:
            return []
        return self._manifests().get(version, [])

    def months(self, version: int | None = None) -> dict[int | None, str]:
        """The folder of each month in a version, by default the last."""
        entries = self._entries(self.version() if version is None else version)
        return {e["AnioMes"]: e["folder"] for e in entries if e["folder"] is not None}

    def schema(self, version: int | None = None) -> T.StructType:
        entries = self._entries(self.version() if version is None else version)
        if not entries:
            raise ValueError(f"no version of a table in {self.path}")
        return T.StructType.fromJson(json.loads(entries[0]["schema"]))

    # -- rows ---------------------------------------------------------------------------------------------------

    def read(self, months: Iterable[int | None] | None = None, version: int | None = None) -> DataFrame:
        """The rows of all or some months. Folders of other months are not even listed."""
        version = self.version() if version is None else version
        schema, held = self.schema(version), self.months(version)
        wanted = held if months is None else [m for m in months if m in held]
        paths = [f"{held[m]}/{MONTH}={NO_MONTH if m is None else m}" for m in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths).select(*schema.names)

    def replace(self, rows: DataFrame, months: Iterable[int | None] | None = None, mark: int | None = None, base: int | None = None) -> list[int | None]:
        """Make `rows` the content of their months, and of `months` where given: one without rows is dropped. Returns the months.

        Other months stay as they are in version `base`, by default the last. `mark` is kept with the version.
        """
        latest = self.version()
        base = latest if base is None else base
        held = self.months(base) if base is not None else {}
        folder = f"{self.path}/data/version=v{uuid.uuid4().hex}"
        rows.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(folder)
        written = self._months_in(folder)
        changed = {*written, *(months or [])}
        kept = {m: f for m, f in held.items() if m not in changed} | {m: folder for m in written}
        self._publish(kept, self._merged_schema(rows.schema, base), mark, (latest or 0) + 1)
        return sorted(changed, key=lambda m: (m is None, m))

    def _months_in(self, folder: str) -> list[int | None]:
        """The months written to a folder, by the names in it."""
        path, system = self._hadoop(folder)
        names = [status.getPath().getName() for status in system.listStatus(path)]
        months = [name.removeprefix(f"{MONTH}=") for name in names if name.startswith(f"{MONTH}=")]
        return [None if m == NO_MONTH else int(m) for m in months]

    def rewrite(self, months: Iterable[int | None], change: Callable[[DataFrame], DataFrame]) -> list[int | None]:
        """Update in place: `change` maps the rows of `months`, and only those are read and written."""
        months = list(months)
        return self.replace(change(self.read(months)), months)

    def add_column(self, name: str, kind: T.DataType) -> None:
        """A new column that is NULL everywhere until months are rewritten; no file is touched."""
        version = self.version()
        schema = self.schema(version)
        if name not in schema.names:
            self._publish(self.months(version), schema.add(name, kind), None, version + 1)

    def expire(self, keep: int = 1) -> list[str]:
        """Delete the folders that none of the last `keep` versions uses; returns them."""
        last = self.version()
        if last is None:
            return []
        used = {f for v in range(max(1, last - keep + 1), last + 1) for f in self.months(v).values()}
        old = sorted({r["folder"] for rows in self._manifests().values() for r in rows if r["folder"] is not None} - used)
        for folder in old:
            path, system = self._hadoop(folder)
            system.delete(path, True)
        return old

    def _merged_schema(self, schema: T.StructType, base: int | None) -> T.StructType:
        """The columns of the table so far, then new ones; the month last, as Spark reads it."""
        fields = [] if base is None else [f for f in self.schema(base) if f.name != MONTH]
        fields += [f for f in schema if f.name != MONTH and f.name not in {x.name for x in fields}]
        return T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField(MONTH, schema[MONTH].dataType)])

    def _publish(self, months: dict[int | None, str], schema: T.StructType, mark: int | None, version: int) -> None:
        text = schema.json()
        # A version without months still has its schema and mark.
        entries = [(m, f, text, mark) for m, f in months.items()] or [(None, None, text, mark)]
        rows = pa.table([pa.array(c, f.type) for c, f in zip(zip(*entries), MANIFEST_ARROW)], schema=MANIFEST_ARROW)
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").parquet(f"{self.path}/manifest/version={version}")
