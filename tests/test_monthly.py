"""Month-wise tables, stored price sums, and the streams that keep them."""

import pytest
from pyspark.sql import functions as F, types as T

from salesmill.operators import dashboard
from salesmill.operators.clean import clean, finish
from salesmill.operators.impute import level_means, prepare_fills, price_groups
from salesmill.operators.price_store import PriceStore
from salesmill.plans.profiles import PROFILES
from salesmill.plans.staging import new_path, stage
from salesmill.sinks.monthly import MonthlyTable
from salesmill.sources import files
from salesmill.streaming.jobs import customer_months, monthly_totals, stream_moving_fills, stream_totals

AS_OF = "2001-08-01"
SPEC = PROFILES["datamart"].imputation


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, "id long, v string, AnioMes int")


def same_rows(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.fixture(scope="module")
def cleaned(spark, raw):
    return stage(clean(raw, "datamart", AS_OF), "cleaned")


def test_only_changed_months_are_written_and_read(spark):
    table = MonthlyTable(spark, new_path(spark, "monthly"))
    assert table.version() is None
    table.replace(rows_of(spark, (1, "a", 202301), (2, "b", 202302), (3, "c", None)))
    first = table.months()
    assert table.replace(rows_of(spark, (4, "d", 202302))) == [202302]
    second = table.months()
    assert second[202301] == first[202301] and second[None] == first[None] and second[202302] != first[202302]
    assert sorted(r.id for r in table.read().collect()) == [1, 3, 4]
    assert sorted(r.id for r in table.read(version=1).collect()) == [1, 2, 3]
    only = table.read([202302, 209901])
    assert all("AnioMes=202302" in f for f in only.inputFiles()) and [r.id for r in only.collect()] == [4]
    # A month that is named but has no rows goes.
    table.replace(rows_of(spark).where("false"), months=[202301])
    assert sorted(r.id for r in table.read().collect()) == [3, 4]
    assert table.read().schema.names == ["id", "v", "AnioMes"]
    assert table.read([202301]).collect() == []


def test_a_failed_write_leaves_the_last_version(spark):
    table = MonthlyTable(spark, new_path(spark, "monthly"))
    table.replace(rows_of(spark, (1, "a", 202301), (2, "b", 202302)))
    bad = rows_of(spark, (5, "x", 202301), (6, "y", 202302)).withColumn("v", F.when(F.col("id") == 6, F.raise_error(F.lit("stop"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        table.replace(bad)
    assert table.version() == 1 and sorted(r.id for r in table.read().collect()) == [1, 2]
    with pytest.raises(Exception, match="already exists"):
        table._publish({}, table.schema(), None, 1)  # a version that another writer took


def test_update_in_place(spark):
    table = MonthlyTable(spark, new_path(spark, "monthly"))
    table.replace(rows_of(spark, (1, "a", 202301), (2, None, 202302), (3, "c", 202302)))
    before = table.months()
    table.add_column("was", T.StringType())
    assert table.months() == before, "a new column touches no file"
    assert {r.was for r in table.read().collect()} == {None}
    table.rewrite([202302], lambda rows: rows.withColumn("was", F.lit("seen")).withColumn("v", F.coalesce("v", F.lit("filled"))))
    got = {r.id: (r.v, r.was) for r in table.read().collect()}
    assert got == {1: ("a", None), 2: ("filled", "seen"), 3: ("c", "seen")}
    assert table.months()[202301] == before[202301]
    assert table.expire(keep=2) == []
    assert table.expire(keep=1) == []  # the first folder still holds January
    table.rewrite([202301], lambda rows: rows)
    assert table.expire(keep=1) == [before[202301]]
    assert {r.id: (r.v, r.was) for r in table.read().collect()} == got


def test_a_corrected_month_is_read_alone(spark, cleaned):
    """The sums of a month replaced from that month's files give the means of a full run."""
    table = MonthlyTable(spark, new_path(spark, "monthly"))
    month = 199703
    table.replace(cleaned.withColumn("unit_price", F.when(F.col("AnioMes") == month, F.lit(1.0)).otherwise(F.col("unit_price"))))
    store = PriceStore(spark, new_path(spark, "store"), SPEC)
    store.refresh(table.read())
    wrong = store.table.months()
    table.replace(cleaned.where(F.col("AnioMes") == month))
    corrected = table.read([month])
    assert corrected.inputFiles() and all(f"AnioMes={month}" in f for f in corrected.inputFiles())
    assert store.refresh(corrected, [month]) == [month]
    assert {m for m, f in store.table.months().items() if wrong[m] != f} == {month}
    groups = price_groups(cleaned, SPEC)
    for level in (1, 2, 3):
        same_rows(store.means(level), level_means(groups, level, SPEC))
    # A source partitioned by month is pruned by the months asked for.
    path = new_path(spark, "by-month")
    cleaned.write.partitionBy("AnioMes").parquet(path)
    plan = spark.read.parquet(path).where(F.col("AnioMes").isin([month]))
    assert "PartitionFilters: [AnioMes#" in plan._jdf.queryExecution().executedPlan().toString().replace("isnotnull(", "")


def test_sums_added_in_parts(spark, cleaned):
    parts = [cleaned.where(F.crc32(F.coalesce("customer_id", F.lit(""))) % 3 == i) for i in range(3)]
    store = PriceStore(spark, new_path(spark, "store"), SPEC)
    for mark, part in enumerate(parts):
        store.add(part, mark)
        store.add(part, mark)  # a repeated batch
    same_rows(store.means(1), level_means(price_groups(cleaned, SPEC), 1, SPEC))
    got, want = store.fills(), prepare_fills(cleaned, SPEC)
    assert (got.n_missing, got.n_bytes) == (want.n_missing, want.n_bytes)
    same_rows(got.table, want.table.select(*got.table.columns))
    with pytest.raises(ValueError, match="another run"):
        store.add(parts[0], 0)
    some = store.fills([199703])
    same_rows(some.table, want.table.where("AnioMes = 199703").select(*got.table.columns))


def test_a_replayed_first_batch(spark):
    store = PriceStore(spark, new_path(spark, "store"), SPEC)
    kind = "AnioMes int, region string, product_id string, product_category string, unit_price double"
    first = spark.createDataFrame([(202301, "r", "p", "c", 5.0), (202302, "r", "p", "c", 7.0)], kind)
    other = spark.createDataFrame([(202301, "r", "p", "c", 9.0)], kind)
    store.add(first, 0)
    store.add(other, 0)  # the batch was cut anew before it was committed
    assert [r.mean_price for r in store.means(4).collect()] == [9.0]


def test_stream_of_moving_means_restarts(spark, raw):
    """Batch by batch, rows are filled from all rows so far; in the end the means are those of one run."""
    source, target, state = (new_path(spark, x) for x in ("in", "out", "state"))
    p = PROFILES["datamart"]
    store = PriceStore(spark, new_path(spark, "store"), p.imputation)
    seen = None
    for i in range(3):
        part = raw.where(F.crc32(F.coalesce("transaction_id", F.lit(""))) % 3 == i)
        part.coalesce(1).write.mode("append").options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(source)
        rows = clean(files.stream_csv(spark, source), p, AS_OF)
        stream_moving_fills(rows, store, target, state).awaitTermination()
        batch = clean(part, p, AS_OF)
        seen = batch if seen is None else seen.unionByName(batch)
        same_rows(store.means(2), level_means(price_groups(seen, p.imputation), 2, p.imputation))
    same_rows(store.fills().table, prepare_fills(seen, p.imputation).table.select(*store.fills().table.columns))
    assert store.table.mark() == 2
    written = spark.read.parquet(target)
    assert written.count() == finish(clean(raw, p, AS_OF), p).count()
    assert written.where("unit_price is null and unit_price_imput is null").isEmpty()


def test_rows_of_a_few_files_are_dealt_and_cleaned_once(spark, raw):
    """A micro-batch of one gzip file is worked on by all cores, and its files are read once for sums and rows."""
    source, target, state = (new_path(spark, x) for x in ("in", "out", "state"))
    raw.coalesce(1).write.options(header=True, escape='"', compression="gzip", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(source)
    read = spark.sparkContext.accumulator(0)

    def seen(value):
        read.add(1)
        return value

    rows = clean(files.stream_csv(spark, source, 1), "datamart", AS_OF)
    parts = []
    rows.writeStream.foreachBatch(lambda b, _: parts.extend(r[0] for r in b.select(F.spark_partition_id()).distinct().collect())).trigger(availableNow=True).start().awaitTermination()
    assert len(parts) == spark.sparkContext.defaultParallelism
    store = PriceStore(spark, new_path(spark, "store"), SPEC)
    counted = F.udf(seen, "string").asNondeterministic()
    stream_moving_fills(rows.withColumn("region", counted("region")), store, target, state).awaitTermination()
    assert read.value == clean(raw, "datamart", AS_OF).count()
    same_rows(store.means(2), level_means(price_groups(clean(raw, "datamart", AS_OF), SPEC), 2, SPEC))


def test_stream_of_months_and_customers(spark, raw):
    source, target, state = (new_path(spark, x) for x in ("in", "out", "state"))
    for i in range(2):  # two runs; the second goes on with the state of the first
        part = raw.where(F.crc32(F.coalesce("transaction_id", F.lit(""))) % 2 == i)
        part.coalesce(1).write.mode("append").options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(source)
        rows = finish(clean(files.stream_csv(spark, source), "datamart", AS_OF), "datamart")
        stream_totals(customer_months(rows, late_months=1200), target, state).awaitTermination()
    want = dashboard.monthly(finish(clean(raw, "datamart", AS_OF), "datamart"))
    same_rows(monthly_totals(spark, target).select(*want.columns), want)


def test_closed_months_take_no_rows(spark, tmp_path):
    """February stays open while March is the latest month, and closes with April."""
    source, target, state = tmp_path / "in", new_path(spark, "out"), new_path(spark, "state")
    source.mkdir()
    kind = "date date, customer_id string, total_amount double, quantity long"
    days = [("2001-02-10", "2001-03-01"), ("2001-02-11",), ("2001-04-01",), ("2001-02-12", "2001-03-02", "2001-04-02")]
    for n, batch in enumerate(days):
        (source / f"{n}.json").write_text("".join('{"date": "%s", "customer_id": "c%d", "total_amount": 1.5, "quantity": 1}\n' % (d, n) for d in batch))
        stream_totals(customer_months(spark.readStream.schema(kind).json(str(source))), target, state).awaitTermination()
    got = {r.year_month: (r.revenue, r.customers) for r in monthly_totals(spark, target).collect()}
    assert got == {"2001-02": (3.0, 2), "2001-03": (3.0, 2), "2001-04": (3.0, 2)}


def _jobs(spark, work):
    """What `work` gives, and how many Spark jobs it took."""
    group = new_path(spark, "group")
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_manifests_are_read_once(spark):
    """Looking for the last version takes no Spark job once its manifest is known; those of other writers are found."""
    table = MonthlyTable(spark, new_path(spark, "monthly"))
    other = MonthlyTable(spark, table.path)
    assert other.version() is None and other.mark() is None
    rows = spark.createDataFrame([(202301, "a"), (202302, "b"), (None, "c")], "AnioMes int, x string")
    for mark in (0, 1, None, 3):
        assert table.replace(rows, mark=mark) == [202301, 202302, None]
    assert table.version() == 4
    facts = lambda t: (t.version(), t.version(before=3), t.mark(), sorted(t.months(), key=str), t.schema().names)
    assert _jobs(spark, lambda: facts(table)) == ((4, 2, 3, [202301, 202302, None], ["x", "AnioMes"]), 0)
    assert facts(other) == facts(table)
    other.replace(rows.where("x = 'a'"), [202301], mark=4)
    assert facts(table) == facts(other) == facts(MonthlyTable(spark, table.path)) and table.version() == 5


def test_fills_of_all_months_read_the_sums_once(spark, monkeypatch):
    store = PriceStore(spark, new_path(spark, "store"), SPEC)
    kind = "AnioMes int, region string, product_id string, product_category string, unit_price double"
    rows = [(202301, "r", "p", "c", 5.0), (202302, "r", "p", "c", 7.0), (202302, "s", "p", "c", None), (202303, "r", "q", "c", None)]
    store.add(spark.createDataFrame(rows, kind))
    reads, read = [], store.table.read
    monkeypatch.setattr(store.table, "read", lambda months=None, version=None: [reads.append(months), read(months, version)][1])
    same_rows(store.fills([202301, 202302, 202303]).table, store.fills().table)
    assert len(reads) == 2
    one = store.fills(m for m in [202302])
    assert len(reads) == 4 and [(r.region, r.fill_price) for r in one.table.collect()] == [("s", 6.0)]
