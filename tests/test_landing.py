"""How the extract is landed: which rows move, and how often it is written."""

from salesmill.plans import catalog
from salesmill.plans.staging import new_path
from salesmill.sinks import tables
from salesmill.sources import files

SF_DIR = "/root/testdata/sf0.001"


def test_landing_compressed_files_moves_no_rows(spark, raw):
    """Every task writes what it has read: three small gzip files stay three."""
    path = new_path(spark, "csv")
    tables.write_csv(raw, path, 3, "gzip")
    landed = files.land_bronze(spark, path, new_path(spark, "bronze"))
    assert len(landed.inputFiles()) == 3
    read = files.read_csv(spark, path)
    assert landed.exceptAll(read).isEmpty() and read.exceptAll(landed).isEmpty()


def test_lines_are_no_second_copy(spark):
    before = catalog.landed_lines(spark, SF_DIR)
    assert not [key for key in catalog._LANDED if key[2] == "landed-lines"]
    assert before.columns == ["value"] and before.count() == catalog.landed(spark, SF_DIR).count()
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"


def test_narrow_queries_land_only_their_columns(spark, monkeypatch):
    """A query over one column lands that column alone, until the whole extract is there."""
    monkeypatch.setattr(catalog, "_LANDED", {})
    lifecycle = catalog.landed(spark, SF_DIR, ["product_lifecycle"])
    [path] = catalog._LANDED.values()
    assert spark.read.parquet(path).columns == ["product_lifecycle"]
    whole = catalog.landed(spark, SF_DIR)
    assert lifecycle.exceptAll(whole.select("product_lifecycle")).isEmpty() and lifecycle.count() == whole.count()
    assert catalog.landed(spark, SF_DIR, ["region"]).columns == ["region"] and len(catalog._LANDED) == 2


def test_files_of_the_whole_extract_need_no_landing(spark, monkeypatch):
    """A query that writes the whole extract to files writes it once."""
    monkeypatch.setattr(catalog, "_LANDED", {})
    path = catalog._csv_copy(spark, SF_DIR, "gzip")
    assert not catalog._LANDED
    written = files.read_csv(spark, path).select("transaction_id", "product_id", "quantity")
    whole = catalog.raw(spark, SF_DIR).select("transaction_id", "product_id", "quantity")
    assert written.exceptAll(whole).isEmpty() and whole.exceptAll(written).isEmpty()


def _shuffles(df):
    """Joins and exchanges of the plan as text, with nothing broadcast but what hints ask for."""
    return df._jdf.queryExecution().sparkPlan().toString()


def test_lines_move_for_orders_and_parts_only(spark):
    """Orders meet their customers first, so no join of the lines has the customer as its key."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _shuffles(catalog.raw(spark, SF_DIR)).split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    depth = lambda word: min(line.index("Join") for line in plan if "Join" in line and word in line)
    assert depth("l_orderkey") < depth("c_custkey")


def test_fields_of_a_line_are_counted_as_split_does(spark):
    from pyspark.sql import functions as F
    from salesmill.sources.lines import n_fields

    lines = spark.createDataFrame([("",), (",",), ("a,b,",), ("ñ,\u2028,x",), (None,)], "value string")
    counted = lines.select(n_fields(F.col("value")).alias("n"), F.size(F.split("value", ",")).alias("by_split")).collect()
    assert [r.n for r in counted] == [1, 2, 3, 3, None] and [r.by_split for r in counted[:4]] == [1, 2, 3, 3]


def test_a_date_layout_is_rewritten_once(spark):
    """Only the layout that fits is rewritten, and the values are those of rewriting by every layout in turn."""
    from pyspark.sql import functions as F
    from salesmill.functions import dates

    texts = ["1997-3-1", "3/14/1997", "14-03-1997", "19970314", "1997/3/14", "3/14/1997\n", "14/3/1997", "3-14-1997", "2/30/1997", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for layouts in (["M/d/y", "d-M-y"], ["M/d/y", "d-M-y", "yyyyMMdd", "y/M/d"], ["d/M/y", "M-d-y"]):
        new, c = dates._date_of(F.col("s"), *layouts), F.col("s")
        for layout in layouts:
            c = F.regexp_replace(c, *dates.REWRITES[layout])
        old = F.when(c.rlike(dates.ISO), c.try_cast("date"))
        rows = df.select("s", new.alias("new"), old.alias("old")).collect()
        assert [r.new for r in rows] == [r.old for r in rows], rows
        n = df.select(new.alias("new"))._jdf.queryExecution().analyzed().toString().count("regexp_replace")
        assert n == len(layouts)


def test_gzip_copies_are_written_at_the_fastest_level(spark, tmp_path):
    """The text of a copy compresses further at zlib's usual level."""
    import gzip

    rows = spark.range(20000).selectExpr("cast(id * id % 9973 as string) AS a", "concat('T', id, '-', id % 7) AS b").coalesce(1)
    tables.write_csv(rows, str(tmp_path / "c"), compression="gzip")
    [file] = (tmp_path / "c").glob("*.gz")
    assert len(gzip.compress(gzip.decompress(file.read_bytes()), 6)) < 0.97 * file.stat().st_size


def _copies(monkeypatch, label):
    """The paths that queries take for copies of that label."""
    paths = []
    monkeypatch.setattr(catalog, "new_path", lambda spark, x: [p := new_path(spark, x), paths.append(p) if x == label else None][0])
    return paths


def _compressed_copy(spark, path, noted):
    """Whether the copy holds these rows in members, in less than half the bytes of plain CSV, and is read by several tasks."""
    import glob
    import gzip
    import os

    found = glob.glob(f"{path}/part-*")
    assert found and all(f.endswith(".csv.gz") for f in found)
    size, text = sum(map(os.path.getsize, found)), sum(len(gzip.open(f).read()) for f in found)
    assert size < text / 2
    view = files.external_view(spark, f"{path}/*.gz", "a_copy", block_bytes=20_000)
    assert view.rdd.getNumPartitions() > len(found)
    got, want = view.select(*noted.columns), noted
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_the_view_is_over_compressed_files(spark, monkeypatch):
    from pyspark.sql import functions as F

    paths = _copies(monkeypatch, "external")
    view = catalog.external_view(spark, SF_DIR)
    whole = catalog.raw(spark, SF_DIR)
    noted = whole.select("transaction_id", F.concat(F.lit('"'), "region", F.lit('",\n'), "product_id").alias("notes"), F.nullif("modified_date", F.lit("")).alias("modified_date"))
    assert view.exceptAll(noted).isEmpty() and view.count() == noted.count()
    _compressed_copy(spark, *paths, noted)


def test_quoted_files_are_compressed(spark, monkeypatch):
    from pyspark.sql import functions as F

    paths = _copies(monkeypatch, "quoted")
    landed = catalog.quoted_csv(spark, SF_DIR)
    whole = catalog.raw(spark, SF_DIR)
    assert landed.count() == whole.count()
    noted = whole.select("product_id", "customer_id", F.concat(F.lit('"'), F.coalesce("notes", F.lit("")), F.lit('",\n\n'), "product_id").alias("notes"))
    assert landed.select(*noted.columns).exceptAll(noted).isEmpty()
    _compressed_copy(spark, *paths, noted)


def test_members_replace_an_earlier_copy(spark, tmp_path):
    """Members are cut by rows, across batches, and a copy written again takes the place of the first."""
    import gzip

    path = str(tmp_path / "c")
    for n in (30, 60_000):
        tables.write_csv(spark.range(n).selectExpr("id a", "if(id % 3 = 0, null, 'x\ny') b").coalesce(1), path, compression="members")
    [file] = (tmp_path / "c").glob("*.gz")
    data = file.read_bytes()
    assert data.count(b"\x1f\x8b\x08") >= 3  # 25,000 rows a member
    assert gzip.decompress(data).decode() == "a,b\n" + "".join(f"{i},\n" if i % 3 == 0 else f'{i},"x\ny"\n' for i in range(60_000))
