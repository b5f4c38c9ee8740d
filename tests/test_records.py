"""Quoted CSV read in blocks: equal to Spark's multi-line reader, which reads a file in one task."""

import csv
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from salesmill.sources import files, records

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
BITS = ["x", "yy", '"', ",", "\n", '""', " ", "é", '"a"', "long text here", ""]


def csv_text(seed, newline="\n", stray=False):
    """A CSV file with quoted breaks, doubled quotes, blank lines, short and long rows; `stray` leaves quotes inside plain fields."""
    r = random.Random(seed)
    lines = ["h1,h2,h3"]
    for _ in range(r.randint(20, 60)):
        row = []
        for _ in range(r.choice([2, 3, 3, 3, 4])):
            v = "".join(r.choice(BITS) for _ in range(r.randint(0, 6)))
            if r.random() < 0.5 or "\n" in v or "," in v or v.startswith('"') or ('"' in v and not stray):
                v = '"' + v.replace('"', '""').replace("\n", newline) + '"'
            row.append(v)
        lines.append(",".join(row))
        if r.random() < 0.1:
            lines.append("")
    return newline.join(lines) + newline * r.randint(0, 1)


def lines_of(text, cuts, states=None):
    """Arrow rows as a file source gives them: lines belong to the block their first byte is in, and the first of a block's to the one before."""
    rows, at, block = [], 0, 0
    for line in text.encode().split(b"\n"):
        while cuts and at > cuts[0]:
            block = cuts.pop(0)
        rows.append((block, line))
        at += len(line) + 1
    return rows


def batch_of(rows, states=None):
    columns = [pa.array(["f"] * len(rows)), pa.array([b for b, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.binary())]
    names = ["file", "block", "value"]
    if states is not None:
        columns += [pa.array([states[b][i] for b, _ in rows], t) for i, t in enumerate((pa.bool_(), pa.int64(), pa.bool_()))]
        names += ["begins", "owner", "crlf"]
    return pa.RecordBatch.from_arrays(columns, names=names)


@pytest.mark.parametrize("seed", range(30))
def test_cutting_into_blocks_and_batches(seed):
    """Any cut into blocks and Arrow batches gives the records of the csv module."""
    r = random.Random(seed)
    text = csv_text(seed)
    want = [row for row in csv.reader(io.StringIO(text, newline="")) if row]
    rows = lines_of(text, sorted(r.sample(range(1, len(text.encode())), r.randint(0, 12))))
    size = r.randint(1, 9)
    batches = lambda states=None: [batch_of(rows[i : i + size], states) for i in range(0, len(rows), size)]
    states, begins, owner = {}, False, 0
    folds = pa.Table.from_batches(records.fold_blocks(iter(batches()))).to_pylist()
    for f in folds:
        states[f["block"]] = (begins, owner if begins else None, f["crlf"])
        if not begins or f["closes"]:
            owner = f["block"]
        begins = f["inside"] if begins else f["outside"]
    cut = lambda pieces: [row for b in records._cutter(pieces)(iter(batches(states))) for row in b.to_pylist()]
    found, crossing = [p["value"] for p in cut(False)], {}
    for p in sorted(cut(True), key=lambda p: p["block"]):
        crossing.setdefault(p["owner"], []).append(p["value"])
    found += [b"\n".join(parts) for parts in crossing.values()]
    parse = lambda rows: sorted(row for v in rows if v for row in csv.reader(io.StringIO(v.decode(), newline="")))
    assert parse(found) == sorted(want)


@pytest.mark.parametrize(("newline", "stray"), [("\n", False), ("\n", True), ("\r\n", False)])
def test_equal_to_the_multiline_reader(spark, tmp_path, newline, stray):
    for seed in range(3):
        (tmp_path / f"{seed}.csv").write_bytes(csv_text(seed, newline, stray).encode())
    (tmp_path / "3.csv").write_bytes(b"")
    (tmp_path / "4.csv").write_bytes(b'h1,h2,h3\n"never closed,1,2\n3,4,5')
    small = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": "60"}
    options = files.CSV_OPTIONS | {"header": True}
    want = spark.read.schema(SCHEMA).options(**options, multiLine=True).csv(str(tmp_path))
    whole = sorted(map(str, want.collect()))
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        lines = records.text_lines(spark, str(tmp_path))
        assert lines.select("file", "block").distinct().count() > 20
        for broadcast_bytes in (records.BROADCAST_BYTES, 0):
            got = records.parse_records(records.records(lines, True, broadcast_bytes), SCHEMA, options)
            assert sorted(map(str, got.collect())) == whole
        no_header = records.records(lines, header=False)
        assert no_header.where("value = 'h1,h2,h3'").count() == 4
    finally:
        for k in small:
            spark.conf.unset(k)


def test_many_tasks_read_one_file(spark, tmp_path):
    path = str(tmp_path / "one.csv")
    with open(path, "w") as f:
        f.write("h1,h2,h3\n" + "".join(f'{i},"line\none, ""{i}""\n\n",z\n' for i in range(60_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        found = records.records(records.text_lines(spark, path))
        assert found.rdd.getNumPartitions() >= 6
        rows = records.parse_records(found, SCHEMA, files.CSV_OPTIONS)
        assert rows.count() == 60_000
        assert rows.where(F.col("b") != F.concat(F.lit('line\none, "'), "a", F.lit('"\n\n'))).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_changed_file_is_noticed(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("h1,h2,h3\n" + '1,"a\nb",c\n' * 2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = records.text_lines(spark, str(path))
        states = records.block_states(lines)
        known = records._with_states(lines, states.where("block = 0"), records.BROADCAST_BYTES)
        with pytest.raises(Exception, match="cut into other blocks"):
            known.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_corrupt_text_is_kept(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text(",".join(files.RAW_SCHEMA.names) + "\n" + '1,"a\nb"\n' + ",".join("x" * 21) + "\n" + ",".join("y" * 23) + "\n")
    want = spark.read.schema(files.csv_schema(True)).options(**files.CSV_OPTIONS).options(multiLine=True, columnPruning=False).csv(str(path))
    got = files.read_csv(spark, str(path), quoted_newlines=True, keep_corrupt=True)
    rows = got.collect()
    assert sorted(map(str, rows)) == sorted(map(str, want.collect()))
    assert sum(r[files.CORRUPT] is not None for r in rows) == 2
