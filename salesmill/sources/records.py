"""Records of CSV files whose quoted fields hold line breaks, read by many tasks.

A file is read in blocks, each as physical lines by one task that knows nothing of the others. Whether a line break
inside a block ends a record depends on whether the block begins inside quotes, which only the blocks before it tell. So
a first pass folds the lines of every block to what the block does with either beginning: it keeps, swaps or fixes the
state. Those rows, one per block, are composed in file order by window functions. The second pass cuts every block into
records from its known beginning. A record that crosses blocks comes out in pieces, which are joined by the block where
it began; no file and no block is gathered anywhere.

Quotes count as the CSV parser counts them: they open a field only at its start, and a doubled one is text. A field that
is never closed takes the rest of its file (but for a last line break), as it does in the parser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from salesmill.plans.staging import stage

BLOCK = ["file", "block"]
# Bytes of a block's row in a broadcast table, with slack.
BLOCK_ROW_BYTES = 400
BROADCAST_BYTES = 64 << 20


def text_lines(spark: SparkSession, path) -> DataFrame:
    """file, block, value: physical lines (a carriage return stays) of text files, in the order of each block."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # Two passes must cut the same blocks, also when executors come and go between them.
        spark.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )


def inside_quotes(line: bytes, inside: bool) -> bool:
    """Whether the end of `line` lies inside quotes, given whether its start does."""
    at = 0
    while True:
        if not inside:
            if at == 0 and line[:1] == b'"':
                at = 1
            else:
                # Outside quotes the next quoted field starts at the next comma with a quote.
                at = line.find(b',"', at) + 2
                if at == 1:
                    return False
            inside = True
        at = line.find(b'"', at)
        if at < 0:
            return True
        if line[at + 1 : at + 2] == b'"':
            at += 2
        else:
            inside, at = False, at + 1


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, str, int, pa.Array]]:
    """The lines of one block after another: where they start, file, block, values."""
    n = batch.num_rows
    if not n:
        return
    file, block, value = (batch.column(i) for i in range(3))
    changed = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.nonzero(changed)[0] + 1).tolist(), n]
    for start, end in zip(cuts, cuts[1:]):
        yield start, file[start].as_py(), block[start].as_py(), value[start:end]


def _quoted(values: pa.Array) -> list[int]:
    """Places of the lines that hold a quote; the others change nothing."""
    return np.nonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))[0].tolist()


def fold_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: where it ends if it begins outside or inside quotes, and whether the latter ever gets outside."""
    done, key = [], None
    outside = inside = closes = crlf = None
    for batch in batches:
        for _, file, block, values in _segments(batch):
            if (file, block) != key:
                if key:
                    done.append((*key, outside, inside, closes, crlf))
                key, outside, inside, closes = (file, block), False, True, False
                crlf = values[0].as_py()[-1:] == b"\r"
            for i in _quoted(values):
                line = values[i].as_py()
                same = outside == inside
                outside = inside_quotes(line, outside)
                inside = outside if same else inside_quotes(line, inside)
                closes = closes or not inside
    if key:
        done.append((*key, outside, inside, closes, crlf))
    columns = list(zip(*done)) or [()] * 6
    kinds = [pa.string(), pa.int64(), *[pa.bool_()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[*BLOCK, "outside", "inside", "closes", "crlf"])


def block_states(lines: DataFrame) -> DataFrame:
    """file, block, begins (inside quotes), owner (block in which a record open at its beginning began), crlf. Staged."""
    folded = lines.mapInArrow(fold_blocks, "file string, block long, outside boolean, inside boolean, closes boolean, crlf boolean")
    # One row per block, so a window over a file's blocks stays small however large the file is.
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum((F.col("outside") & ~F.col("inside")).cast("long")).over(order)
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "swaps"))
    last = F.last("fixed", ignorenulls=True).over(before)
    swapped = F.coalesce(F.lag("swaps").over(order), F.lit(0)) - F.coalesce(F.col("last.swaps"), F.lit(0))
    states = stage(folded, "block-folds").withColumn("swaps", swaps).withColumn("fixed", fixed).withColumn("last", last)
    states = states.withColumn("begins", F.coalesce(F.col("last.outside"), F.lit(False)) != (swapped % 2 == 1))
    starts_record = F.when(~F.col("begins") | F.col("closes"), F.col("block"))
    states = states.withColumn("owner", F.last(starts_record, ignorenulls=True).over(before)).withColumn("crlf", F.first("crlf").over(order))
    return stage(states.select(*BLOCK, "begins", "owner", "crlf"), "block-states")


def _with_states(lines: DataFrame, states: DataFrame, broadcast_bytes: int) -> DataFrame:
    """`lines` with the state their block begins in, still in the order of each block."""
    if states.count() * BLOCK_ROW_BYTES <= broadcast_bytes:
        known = lines.join(F.broadcast(states), BLOCK, "left")
    else:
        numbered = lines.withColumn("line_no", F.monotonically_increasing_id())
        known = numbered.join(states, BLOCK, "left").repartition(*BLOCK).sortWithinPartitions(*BLOCK, "line_no")
    missing = F.raise_error(F.lit("a file was cut into other blocks, or has changed, since its first pass"))
    return known.select(*BLOCK, "value", F.coalesce("begins", missing.cast("boolean")).alias("begins"), "owner", "crlf")


def _cutter(pieces: bool):
    """A function of batches that cuts blocks into records; with `pieces`, into those of records that cross blocks instead.

    Out: value, owner, block, first. `first` marks a file's first record that is not empty.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, open_from = None, [], None
        inside = crlf = awaited = False
        file = block = None

        def rows(values: pa.Array, owners, first) -> pa.RecordBatch:
            n = len(values)
            parts = [pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(owners, pa.int64())]
            return pa.RecordBatch.from_arrays([values, *parts, pa.array(first, pa.bool_())], names=["value", "file", "block", "owner", "first"])

        def left() -> Iterator[pa.RecordBatch]:
            """The end of a block inside a record."""
            if held and pieces:
                yield rows(pa.array([b"\n".join(held)], pa.binary()), [open_from], [awaited])

        for batch in batches:
            for start, file_, block_, values in _segments(batch):
                if (file_, block_) != key:
                    yield from left()
                    key, file, block = (file_, block_), file_, block_
                    inside, owner, crlf = (batch.column(i)[start].as_py() for i in (3, 4, 5))
                    held, open_from, awaited = [], owner if inside else block, block == 0
                ends = np.ones(len(values), bool)
                at = 0
                for i in _quoted(values):
                    if inside:
                        ends[at:i] = False
                    inside = inside_quotes(values[i].as_py(), inside)
                    ends[i], at = not inside, i + 1
                if inside:
                    ends[at:] = False
                whole, joined = ends.copy(), []
                # Records of several lines: from the line after a record's end to the line that ends it.
                stops = np.nonzero(ends)[0]
                starts = np.append(0, stops[:-1] + 1) if len(stops) else stops
                whole[stops[starts < stops]] = False
                if len(stops) and (held or open_from != block):  # it began before these lines
                    whole[stops[0]] = False
                for begin, stop in zip(starts.tolist(), stops.tolist()):
                    if whole[stop]:
                        continue
                    text = b"\n".join([*held, *values[begin : stop + 1].to_pylist()])
                    held = []
                    if open_from != block:  # it began in an earlier block
                        if pieces:
                            yield rows(pa.array([text], pa.binary()), [open_from], [False])
                        open_from = block
                    else:
                        joined.append((stop, text))
                if len(stops):
                    open_from = block
                held += values[int(stops[-1]) + 1 if len(stops) else 0 :].to_pylist()
                places = np.concatenate([np.nonzero(whole)[0], np.array([p for p, _ in joined], np.int64)])
                records = pa.concat_arrays([values.filter(pa.array(whole)), pa.array([t for _, t in joined], pa.binary())])
                if crlf and len(records):  # such a file's line ends are those of all its lines, in quotes too
                    records = pc.replace_substring_regex(pc.replace_substring(records, "\r\n", "\n"), r"\r\z", "")
                filled = pc.not_equal(pc.binary_length(records), 0)
                places, records = places[filled.to_numpy(zero_copy_only=False)], records.filter(filled)
                if not len(records):
                    continue
                first = np.zeros(len(records), bool)
                if awaited:
                    first[places.argmin()], awaited = True, False
                if not pieces:
                    yield rows(records, [None] * len(records), first)
        yield from left()

    return cut


_CUT = "value binary, file string, block long, owner long, first boolean"


def records(lines: DataFrame, header: bool = True, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """value: one row per CSV record of `lines` (`text_lines` or another source of blocks), without empty ones and headers.

    Records that lie in one block are read lazily, in one pass over the lines. The few that cross blocks are found, joined
    and staged right away.
    """
    states = block_states(lines)
    known = _with_states(lines, states, broadcast_bytes)
    pieces = known.mapInArrow(_cutter(True), _CUT)
    # One row per block that the record crosses.
    parts = F.array_sort(F.collect_list(F.struct("block", F.col("value").cast("string").alias("text"))))
    crossing = pieces.groupBy("file", "owner").agg(parts.alias("p"), F.max("first").alias("first"))
    crossing = crossing.withColumn("value", F.array_join(F.col("p.text"), "\n")).join(states.where("crlf").select("file", "crlf").distinct(), "file", "left")
    crossing = crossing.withColumn("value", F.when(F.col("crlf"), F.regexp_replace("value", r"\r(\n|\z)", "$1")).otherwise(F.col("value")))
    crossing = stage(crossing.select("value", "first"), "crossing-records")
    inner = known.mapInArrow(_cutter(False), _CUT).select(F.col("value").cast("string").alias("value"), "first")
    both = inner.unionByName(crossing).where("value <> ''")
    return (both.where(~F.col("first")) if header else both).select("value")


def parse_records(found: DataFrame, schema: T.StructType, options: dict) -> DataFrame:
    """Records to columns, by Spark's own CSV parser."""
    text = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "header"}
    parsed = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), text | {"multiLine": "true"})
    return found.select(parsed.alias("r")).select("r.*")
