"""Gzip files cut into blocks: every line once, whatever the blocks and members."""

import gzip
import io
import random
import zlib

import pytest

from salesmill.sources import files, gzip_members
from salesmill.sources.gzip_members import _Restored, block_lines, first_member


def members(texts, padding=b""):
    return padding.join(gzip.compress(t, compresslevel=r) for t, r in zip(texts, [1, 9, 6, 0, 5] * len(texts)))


def by_blocks(data, step):
    out = []
    for at in range(0, len(data), step):
        for lines in block_lines(_Restored(io.BytesIO(data)), at, min(at + step, len(data)), len(data)):
            out += lines
    return out


@pytest.mark.parametrize("seed", range(25))
def test_every_line_once(seed):
    r = random.Random(seed)
    texts = [bytes(r.choice(b"ab\n\r,") for _ in range(r.choice((0, 1, 30, 400)))) for _ in range(r.randint(1, 25))]
    if seed % 3 == 0:
        texts = [t.replace(b"\n", b"") if r.random() < 0.6 else t for t in texts]  # members without a line break
    data = members(texts, padding=b"\0" * (seed % 2 * 5))
    whole = b"".join(texts)
    want = whole.split(b"\n")
    want = want[:-1] if want[-1] == b"" else want
    for step in (1, 7, 40, 150, 10**6):
        assert by_blocks(data, step) == want


def test_large_members():
    r = random.Random(1)
    texts = [b"".join(b"%d,%d\n" % (i, r.getrandbits(200)) for i in range(60_000)) for _ in range(3)]
    data = members(texts)
    assert by_blocks(data, 1 << 20) == b"".join(texts).split(b"\n")[:-1]


def test_a_false_start_fails_the_read():
    """A member stored inside a member, byte by byte, looks like a start; the chain tells it is none."""
    inner = gzip.compress(b"inner text\n" * 50)
    pack = zlib.compressobj(0, wbits=31)
    outer = pack.compress(b"first\n" + b"x" * 500 + inner + b"\nlast\n") + pack.flush()
    at = outer.find(inner)
    assert first_member(_Restored(io.BytesIO(outer)), 1, len(outer)) == at
    with pytest.raises(ValueError, match="look like a gzip member"):
        by_blocks(outer, 300)
    assert by_blocks(outer, len(outer))[0] == b"first"


def test_damaged_files():
    data = members([b"a,b\n" * 1000, b"c,d\n" * 1000])
    with pytest.raises(EOFError):
        by_blocks(data[:-9], 10**6)
    with pytest.raises((ValueError, zlib.error)):
        by_blocks(data + b"junk", 10**6)


def test_read_and_write_csv(spark, raw, tmp_path):
    """The sink's files are read by many tasks and by Spark's own reader alike."""
    path = str(tmp_path / "members")
    gzip_members.write_members(raw.repartition(2), path, member_rows=200)
    own = files.read_csv(spark, path)
    got = files.read_gzip_csv(spark, path, block_bytes=20_000)
    assert got.rdd.getNumPartitions() > 4
    assert got.exceptAll(own).isEmpty() and own.exceptAll(got).isEmpty() and got.count() == raw.count()
    blocks = gzip_members.gzip_lines(spark, gzip_members.listed(spark, path), 20_000).select("block").distinct()
    assert blocks.count() > 3  # several tasks found lines
    landed = files.land_bronze(spark, path + "/*.gz", str(tmp_path / "bronze"))
    assert landed.exceptAll(own).isEmpty() and landed.count() == raw.count()


def test_quoted_breaks_across_members(spark, tmp_path):
    rows = "".join(f'{i},"two\r\nlines, ""{i}""",z\r\n' for i in range(3000)).encode()
    text = ",".join(files.RAW_SCHEMA.names).encode() + b"\r\n" + rows
    (tmp_path / "one.csv.gz").write_bytes(members([text[i : i + 1000] for i in range(0, len(text), 1000)]))
    path = str(tmp_path / "one.csv.gz")
    want = files.read_csv(spark, path, quoted_newlines=True)
    assert want.count() == 3000
    got = files.read_gzip_csv(spark, path, quoted_newlines=True, block_bytes=500)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plain = files.read_gzip_csv(spark, path, block_bytes=500)
    assert sorted(map(str, plain.collect())) == sorted(map(str, files.read_csv(spark, path).collect()))


def test_a_failed_write_leaves_nothing_to_read(spark, tmp_path):
    path = str(tmp_path / "failed")
    rows = spark.range(100).selectExpr("if(id = 77, raise_error('stop'), cast(id as string)) a")
    with pytest.raises(Exception, match="stop"):
        gzip_members.write_members(rows, path)
    assert gzip_members.listed(spark, path) == [] if (tmp_path / "failed").exists() else True
