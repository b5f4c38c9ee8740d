"""Whole jobs: profiles, sources, sinks, streams, quality and dashboard."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from salesmill.operators import dashboard, quality
from salesmill.operators.clean import clean, clean_columns, finish
from salesmill.operators.quantile import exact_quantile
from salesmill.operators.sampling import sample_rows
from salesmill.operators.stats import table_stats
from salesmill.plans.jobs import build_datamart
from salesmill.plans.profiles import PROFILES
from salesmill.plans.staging import new_path
from salesmill.schemas import CLEAN_SCHEMA, LINES_SCHEMA, RAW_COLUMNS, conform
from salesmill.sinks import tables
from salesmill.sources import files, lines
from salesmill.streaming.jobs import latest_totals, monthly_windows, record_progress, stream_clean, stream_split, stream_totals, total_progress

AS_OF = "2001-08-01"


def same_rows(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("profile", PROFILES)
def test_schema_and_row_counts(raw, profile):
    source = lines.parse_lines(lines.to_lines(raw)) if profile == "lines" else raw
    out = build_datamart(source, profile, AS_OF)
    expected = LINES_SCHEMA if profile == "lines" else CLEAN_SCHEMA
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in expected.fields]
    n, n_raw = out.count(), raw.count()
    assert n <= n_raw and (n == n_raw or PROFILES[profile].require_date)
    if profile not in ("external", "microbatch"):
        assert out.where("unit_price IS NOT NULL AND NOT unit_price_imput <=> unit_price").count() == 0
    if profile == "external":
        assert out.where("unit_price IS NOT NULL AND unit_price_imput IS NOT NULL").count() == 0


def test_staged_clean_gives_the_same(raw):
    same_rows(build_datamart(raw, "datamart", AS_OF), build_datamart(raw, "datamart", AS_OF, stage_clean=True))


def test_missing_columns_become_null(raw):
    out = build_datamart(raw.drop("notes", "quantity"), "datamart", AS_OF)
    assert out.columns == CLEAN_SCHEMA.names
    assert out.where("notes IS NOT NULL OR quantity IS NOT NULL OR quantity_null = 0").count() == 0
    assert clean_columns(raw.select("notes"), ["notes", "absent"], F.upper).columns == ["notes"]


def test_unknown_profile(raw):
    with pytest.raises(ValueError, match="known: datamart"):
        clean(raw, "nope")


def test_csv_and_gzip(spark, raw):
    path = new_path(spark, "csv")
    tables.write_csv(raw, path, 2, "gzip")
    back = files.read_csv(spark, path)
    assert back.rdd.getNumPartitions() == 2, "one gzip file is one split"
    same_rows(back, raw.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in RAW_COLUMNS]))
    same_rows(files.land_bronze(spark, path, new_path(spark, "bronze")), back)


def test_missing_path(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_csv(spark, "/tmp/no-such-extract")


def test_corrupt_rows_are_kept_apart(spark, tmp_path):
    path = tmp_path / "x.csv"
    full = ",".join(f"v{i}" for i in range(21))
    path.write_text(",".join(RAW_COLUMNS) + f"\n{full}\na,b\n{full},more\n")
    good, bad = quality.split_corrupt(files.read_csv(spark, str(path), keep_corrupt=True))
    assert len(good.collect()) == 1 and len(bad.collect()) == 2
    assert files.read_csv(spark, str(path)).where("notes IS NULL").count() == 1


def test_quoted_newlines_and_view(spark, tmp_path):
    path = tmp_path / "q.csv"
    cells = [f"v{i}" for i in range(21)]
    cells[18] = '"two\nlines, ""quoted"""'
    path.write_text(",".join(RAW_COLUMNS) + "\n" + ",".join(cells) + "\n")
    files.external_view(spark, str(path), "raw_view")
    assert spark.sql("SELECT notes FROM raw_view").first()[0] == 'two\nlines, "quoted"'


def test_lines(spark, tmp_path):
    cells = [f" v{i} " for i in range(21)]
    cells[1], cells[8], cells[9], cells[18] = "20230115", " ", "", "LÃ¢ Ã±"
    text = [",".join(RAW_COLUMNS), ",".join(cells), ",".join(cells[:20]), ",".join(cells[:19])]
    (tmp_path / "l.txt").write_text("\n".join(text) + "\n", encoding="utf-8")
    read = lines.read_lines(spark, str(tmp_path / "l.txt"))
    rows = lines.parse_lines(read).collect()
    assert len(rows) == 2 and rows[0].transaction_id == "v0" and {r.modified_date for r in rows} == {"v20", ""}
    out = [r.value.split(",") for r in lines.clean_lines(read).collect()]
    assert sorted(map(len, out)) == [23, 24]
    assert all(r[18] == "L ñ" and r[-3:] == ["202311", "1", ""] for r in out)
    good, bad = quality.split_line_rejects(read)
    assert good.count() == 2 and [r.reason for r in bad.collect()] == ["short_row"]


def test_sinks(spark, raw):
    rows = finish(clean(raw, "datamart", AS_OF), "datamart")
    one, two = new_path(spark, "a"), new_path(spark, "b")
    tables.write_parquet(rows.limit(5), one)
    tables.write_parquet(rows, one, by_month=True)
    back = spark.read.schema(CLEAN_SCHEMA).parquet(one).select(*CLEAN_SCHEMA.names)
    same_rows(back, rows)
    plan = dashboard.recent(back, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(AnioMes" in plan
    tables.write_both(rows, [one + "1", two])
    same_rows(spark.read.parquet(one + "1"), spark.read.parquet(two))
    with pytest.raises(ValueError):
        tables.add_column(spark, two, two, "x", F.lit(1))
    assert "x" in tables.add_column(spark, two, two + "x", "x", F.lit(1)).columns
    assert conform(rows.drop("notes")).columns == CLEAN_SCHEMA.names
    tables.write_text(rows.select("region", "quantity"), one + "t", one_file=True)
    assert all("," in r.value for r in spark.read.text(one + "t").limit(5).collect())


def test_stream_equals_batch_and_restarts(spark, raw):
    source, target, state = (new_path(spark, x) for x in ("in", "out", "state"))
    halves = [raw.where(F.crc32(F.coalesce("transaction_id", F.lit(""))) % 2 == i) for i in (0, 1)]
    counts = []
    for half in halves:
        half.coalesce(1).write.mode("append").options(
            header=True, escape='"', compression="gzip", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(source)
        query = stream_clean(spark, source, target, state, "microbatch", AS_OF)
        query.awaitTermination()
        counts.append(sum(p.numInputRows for p in query.recentProgress))
    assert counts == [h.count() for h in halves], "the restart reads the new file only"
    got = spark.read.schema(CLEAN_SCHEMA).parquet(target)
    same_rows(got, finish(clean(files.read_csv(spark, source), "microbatch", AS_OF), "microbatch"))


def test_stream_sets_bad_rows_aside_and_goes_on(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, rejects, state = (new_path(spark, x) for x in ("out", "rejects", "state"))
    full = ",".join(f"v{i}" for i in range(21))
    for n, (name, bad) in enumerate([("a", "a,b"), ("b", f"{full},more")], start=1):
        (source / f"{name}.csv").write_text(",".join(RAW_COLUMNS) + f"\n{full}\n{bad}\n")
        stream_split(spark, str(source), target, rejects, state, "microbatch", AS_OF).awaitTermination()
        assert spark.read.parquet(target).count() == n
    assert sorted(r.reason for r in spark.read.parquet(rejects).collect()) == ["long_row", "short_row"]


def test_recorded_progress_adds_up_over_a_restart(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, rejects, state, progress = (new_path(spark, x) for x in ("out", "rejects", "state", "progress"))
    full = ",".join(["T1", "2023-01-05", *["v"] * 19])
    unusable = ",".join(["T1", "no date", *["v"] * 19])
    for name, lines_in in [("a", [full, "a,b", unusable]), ("b", [f"{full},more"]), ("c", [full, full])]:
        (source / f"{name}.csv").write_text("\n".join([",".join(RAW_COLUMNS), *lines_in]) + "\n")
        stream_split(spark, str(source), target, rejects, state, "datamart", AS_OF, progress=progress).awaitTermination()
    rows = {r["batch"]: (r["rows_in"], r["rows_out"], r["dropped"], r["rejected"]) for r in spark.read.parquet(progress).collect()}
    assert rows == {0: (3, 1, 1, 1), 1: (1, 0, 0, 1), 2: (2, 2, 0, 0)}
    total = total_progress(spark, progress).first()
    assert (total.batches, total.rows_in, total.rows_out, total.dropped, total.rejected) == (3, 6, 3, 1, 2)
    assert spark.read.parquet(target).count() == total.rows_out and spark.read.parquet(rejects).count() == total.rejected
    record_progress(spark, progress, 2, {"rows_in": 2, "rows_out": 2, "dropped": 0, "rejected": 0}, 1.0)  # a repeated batch
    assert total_progress(spark, progress).first() == total


def test_window_totals_take_the_last_state(spark, tmp_path):
    source, target, state = tmp_path / "in", new_path(spark, "out"), new_path(spark, "state")
    source.mkdir()
    schema = "timestamp timestamp_ntz, total_amount double"
    for name, day in [("a", "2001-01-05"), ("b", "2001-01-06")]:
        (source / f"{name}.json").write_text('{"timestamp": "%s 00:00:00", "total_amount": 2.5}\n' % day)
        windows = monthly_windows(spark.readStream.schema(schema).json(str(source)))
        stream_totals(windows, target, state).awaitTermination()
    assert [(r.revenue, r.transactions) for r in latest_totals(spark, target).collect()] == [(5.0, 2)]


def test_quality(raw):
    built = build_datamart(raw, "datamart", AS_OF)
    figures = quality.quality_figures(raw, built).first()
    assert figures.raw_rows == raw.count() and figures.clean_rows == built.count()
    assert figures.pct_prices_filled == 100.0 and 90 < figures.pct_dates_read < 100
    usable, rejected = quality.split_rejects(raw)
    assert usable.count() + rejected.count() == figures.raw_rows
    report = {r.column: r.ok for r in quality.check_schema(raw).collect()}
    assert all(report.values()) and len(report) == 21
    assert not any(r.ok for r in quality.check_schema(raw.select("notes").withColumnRenamed("notes", "x")).collect())


def test_statistics_flavours(raw):
    rows = finish(clean(raw, "datamart", AS_OF), "datamart")
    widths = {"external": 11, "pipeline": 10, "dashboard": 10, "short": 8, "smoke": 2, "count": 1}
    for flavour, width in widths.items():
        assert len(table_stats(rows, flavour).columns) == width
    exact, sketch = table_stats(rows).first(), table_stats(rows, rsd=0.02).first()
    assert abs(sketch.unique_customers / exact.unique_customers - 1) < 0.1
    with pytest.raises(ValueError):
        table_stats(rows, "nope")


def test_dashboard_drops_null_keys_and_sums_to_zero(spark):
    df = spark.createDataFrame([("N", None, None, "1"), (None, 5.0, 1, "2")], "region string, total_amount double, quantity long, transaction_id string")
    assert [tuple(r) for r in dashboard.region_profit(df).collect()] == [("N", 0.0, 0, 1)]


def test_dashboard_pages(raw):
    rows = build_datamart(raw, "datamart", AS_OF).persist()
    for name in dashboard.PAGES:
        for title, out in dashboard.page(rows, name).items():
            assert out.count() > 0, title
    assert dashboard.top_products(rows).count() == 10
    hist = dashboard.price_histogram(rows).agg(F.sum("n")).first()[0]
    assert hist == rows.where("unit_price IS NOT NULL").count()
    rows.unpersist()


@pytest.mark.parametrize("p", [0.0, 0.37, 0.95, 1.0])
def test_exact_quantile_narrows(spark, p):
    """Half of the rows are one value; only 50 values may be ranked, so several passes are needed."""
    df = spark.range(20000).select(F.when(F.col("id") % 2 == 0, 7.0).otherwise((F.col("id") * 7919 % 10007) / 8).alias("x"))
    want = df.agg(F.percentile("x", p)).first()[0]
    assert exact_quantile(df, "x", p, ranked_values=50).first()[0] == want


def test_exact_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.5).first()[0] is None


def test_sample(spark):
    df = spark.range(10000)
    got = sample_rows(df, 500)
    assert got.count() == 500 and got.distinct().count() == 500
    assert sample_rows(df, 20000).count() == 10000
