"""Gzip files read by many tasks, one per block, and a sink that writes files which can be.

A gzip file may be a chain of members that decompress on their own; tools that compress in parallel, and joined files,
give such chains. A task looks for the first member that starts in its block, decompresses members from there until one
starts beyond the block, and goes on to the end of the line it is in, which the next task leaves out. A member's start is
recognised by its header and by decompressing; each task also checks that the next block would start where its own chain
goes on, so bytes that only look like a start fail the job instead of changing rows. A file of one member is read by one
task, as ever.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

BLOCK_BYTES = 64 << 20
CHUNK = 1 << 20
MAGIC = b"\x1f\x8b\x08"
LINE_SCHEMA = "file string, block long, value binary, first boolean"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def starts_member(f, at: int) -> bool:
    """Whether a gzip member starts at `at`: its header and the first of its data make sense."""
    f.seek(at)
    data = f.read(CHUNK // 16)
    if data[:3] != MAGIC or len(data) < 18 or data[3] & 0xE0:
        return False
    try:
        zlib.decompressobj(31).decompress(data, CHUNK)
    except zlib.error:
        return False
    return True


def first_member(f, start: int, stop: int) -> int | None:
    """Where the first member in [start, stop) starts."""
    at = start
    while at < stop:
        f.seek(at)
        data = f.read(min(CHUNK, stop - at) + 2)
        found = data.find(MAGIC)
        while found >= 0:
            if starts_member(f, at + found):
                return at + found
            found = data.find(MAGIC, found + 1)
        at += CHUNK
    return None


def chain(f, start: int, size: int) -> Iterator[tuple[int, bytes]]:
    """The text of the members from `start` on, in chunks, each with the place where its member starts."""
    at = start
    while at < size:
        member, unpack = at, zlib.decompressobj(31)
        f.seek(at)
        while not unpack.eof:
            data = unpack.unconsumed_tail or f.read(CHUNK)
            if not data:
                raise EOFError(f"a gzip member that starts at byte {member} ends too early")
            at += len(data) if not unpack.unconsumed_tail else 0
            if text := unpack.decompress(data, CHUNK):
                yield member, text
        at -= len(unpack.unused_data)
        # Padding between members is no data.
        f.seek(at)
        while (data := f.read(CHUNK)) and not data.strip(b"\0"):
            at += len(data)
        at += len(data) - len(data.lstrip(b"\0"))
        if data and data.lstrip(b"\0")[:2] != MAGIC[:2]:
            raise ValueError(f"no gzip member at byte {at}")
        yield at, b""


def block_lines(f, start: int, stop: int, size: int) -> Iterator[list[bytes]]:
    """The lines that belong to a block: those that begin in its members, but for the line the block before is in."""
    begin = first_member(f, start, stop) if start else 0
    if begin is None:
        return
    skipping, held, checked = start > 0, [], False
    for member, text in chain(f, begin, size):
        if member >= stop and not checked:
            expected = first_member(f, stop, min(size, member + 1))
            if expected != (member if member < size else None):
                raise ValueError(f"bytes at {expected} look like a gzip member but are none: read this file with larger blocks")
            checked = True
            # A block without a line break belongs to the line of the block before.
            if skipping:
                return
        if skipping:
            cut = text.find(b"\n")
            if cut < 0:
                continue
            text, skipping = text[cut + 1 :], False
        if member >= stop:
            cut = text.find(b"\n")
            if cut >= 0:
                yield [b"".join([*held, text[:cut]])]
                return
        *lines, rest = text.split(b"\n")
        if lines:
            lines[0] = b"".join([*held, lines[0]])
            held = []
            yield lines
        held.append(rest)
    if any(held):
        yield [b"".join(held)]


@dataclass
class Block(InputPartition):
    file: str
    start: int
    stop: int
    size: int


class LinesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files, self.block_bytes = json.loads(options["files"]), int(options["blockbytes"])

    def partitions(self) -> list[Block]:
        step = self.block_bytes
        return [Block(file, at, min(at + step, size), size) for file, size in self.files for at in range(0, size, step)] or [Block("", 0, 0, 0)]

    def read(self, block: Block) -> Iterator[pa.RecordBatch]:
        if not block.size:
            return
        system, path = file_system(block.file)
        awaited = block.start == 0
        with system.open_input_file(path) as f:
            for lines in block_lines(_Restored(f), block.start, block.stop, block.size):
                first = [False] * len(lines)
                if awaited:
                    filled = next((i for i, line in enumerate(lines) if line.strip(b"\r")), None)
                    if filled is not None:
                        first[filled], awaited = True, False
                n = len(lines)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.file] * n), pa.array([block.start] * n, pa.int64()), pa.array(lines, pa.binary()), pa.array(first)],
                    names=["file", "block", "value", "first"],
                )


class _Restored:
    """A file whose place other readers of it may move: every run of reads goes on from its own seek."""

    def __init__(self, f):
        self.f, self.at = f, 0

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int) -> bytes:
        self.f.seek(self.at)
        data = self.f.read(n)
        self.at += len(data)
        return data


@dataclass
class Written(WriterCommitMessage):
    path: str


class MembersWriter(DataSourceArrowWriter):
    """Lines to one file per task, a member per so many lines. Files show only once all tasks are done."""

    def __init__(self, options: dict):
        self.folder, self.member_rows = options["path"].rstrip("/"), int(options.get("memberrows", "100000"))
        self.header, self.level = options.get("header"), int(options.get("level", "-1"))
        self.attempt = f"{self.folder}/_temporary/{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, folder = file_system(self.attempt)
        system.create_dir(folder)
        path = f"{folder}/part-{uuid.uuid4().hex}.csv.gz"
        with system.open_output_stream(path, compression=None) as out:
            pack, left = self._member(), self.member_rows
            if self.header is not None:
                out.write(pack.compress(f"{self.header}\n".encode()))
            for batch in batches:
                lines, at = batch.column(0), 0
                while at < len(lines):
                    part = lines.slice(at, left)
                    text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part), "\n")[0]
                    out.write(pack.compress(text.as_buffer()) + pack.compress(b"\n"))
                    at, left = at + len(part), left - len(part)
                    if not left:
                        out.write(pack.flush())
                        pack, left = self._member(), self.member_rows
            out.write(pack.flush())
        return Written(path)

    def _member(self):
        return zlib.compressobj(self.level, wbits=31)

    def commit(self, messages) -> None:
        system, folder = file_system(self.folder)
        for message in messages:
            if message:
                system.move(message.path, f"{folder}/{message.path.rsplit('/', 1)[1]}")
        system.delete_dir(file_system(self.attempt)[1])

    def abort(self, messages) -> None:
        system, folder = file_system(self.attempt)
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)


class GzipLines(DataSource):
    """Lines of gzip files (`files`: JSON of path and size, `blockBytes`), and a sink for them (`path`, `memberRows`, `header`, `level`)."""

    @classmethod
    def name(cls) -> str:
        return "gzip_lines"

    def schema(self) -> str:
        return LINE_SCHEMA

    def reader(self, schema) -> LinesReader:
        return LinesReader(self.options)

    def writer(self, schema, overwrite: bool) -> MembersWriter:
        return MembersWriter(self.options)


def listed(spark: SparkSession, path) -> list[tuple[str, int]]:
    """Path and size of each file, as Spark lists them; no file is opened."""
    found = spark.read.format("binaryFile").load(path).select("path", "length")
    return sorted((row["path"], row["length"]) for row in found.collect())


def gzip_lines(spark: SparkSession, files: list[tuple[str, int]], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """file, block, value, first (a file's first line that is not empty) of `listed` gzip files, one task per block."""
    spark.dataSource.register(GzipLines)
    return spark.read.format("gzip_lines").options(files=json.dumps(files), blockBytes=block_bytes).load()


def readable(files: list[tuple[str, int]]) -> bool:
    """Whether workers can open these files at any byte; not every Hadoop file system has a Python counterpart."""
    try:
        for scheme in {file.split(":", 1)[0]: file for file, _ in files}.values():
            file_system(scheme)
    except (OSError, ValueError, pa.ArrowException):
        return False
    return True


def write_members(df: DataFrame, path: str, member_rows: int = 100_000, header: bool = True, level: int = -1) -> None:
    """CSV in gzip files of many members, which any gzip tool reads and `gzip_lines` splits.

    With `header` each file begins with the column names. `level` is zlib's.
    """
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines = df.select(F.to_csv(F.struct(*df.columns), options).alias("value"))
    spark = df.sparkSession
    spark.dataSource.register(GzipLines)
    written = lines.write.format("gzip_lines").options(path=path, memberRows=member_rows, level=level)
    (written.option("header", ",".join(df.columns)) if header else written).mode("append").save()
