"""Every registered query: name -> function of (session, folder of star-schema tables).

All of them read the whole transactions derived from the tables. Queries about files write those rows to
the shared folder first and read them back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmill.functions import dates, numeric, rules
from salesmill.functions.categories import CATEGORY_COLUMNS, CATEGORIZERS
from salesmill.functions.text import clean_text, strip
from salesmill.operators import dashboard, date_layouts, quality, sketches
from salesmill.operators.clean import clean, clean_columns, finish
from salesmill.operators.impute import BROADCAST_BYTES, apply_fills, global_mean, level_means, prepare_fills, price_groups, impute
from salesmill.operators.price_store import PriceStore
from salesmill.operators.sampling import sample_rows, sample_strata
from salesmill.operators.stats import table_stats
from salesmill.plans.jobs import build_datamart, run_job
from salesmill.plans.profiles import PROFILES, prepare
from salesmill.plans.reuse import ResultCache
from salesmill.plans.session import tune
from salesmill.plans.staging import new_path, stage
from salesmill.schemas import CLEAN_SCHEMA, RAW_COLUMNS
from salesmill.sinks import tables
from salesmill.sinks.monthly import MonthlyTable
from salesmill.sources import files, gzip_members, lines
from salesmill.sources.star_schema import transactions_raw
from salesmill.streaming.jobs import (
    customer_months, latest_totals, monthly_totals, monthly_windows, stream_clean, stream_impute, stream_moving_fills, stream_split,
    stream_totals, total_progress,
)

Query = Callable[[SparkSession, str], DataFrame]

ID_AND_DATE = ["transaction_id", "date"]
PRICE_COLUMNS = [*ID_AND_DATE, "region", "product_id", "product_category", "unit_price"]

# The day that stands for "today" in every registered query.
AS_OF = "2001-08-01"

TEXT_COLUMNS = RAW_COLUMNS
DATE_PROFILES = ["datamart", "external", "chunked", "microbatch"]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_raw(tune(spark), sf_dir)


_LANDED: dict[tuple[str, str, str], str] = {}


def _kept(spark: SparkSession, sf_dir: str, label: str) -> DataFrame | None:
    """What `_once` wrote earlier, if it is still there."""
    path = _LANDED.get((spark.sparkContext.applicationId, sf_dir, label))
    try:
        return spark.read.parquet(path) if path else None
    except AnalysisException:  # the shared folder has been cleared since
        return None


def _once(spark: SparkSession, sf_dir: str, label: str, make: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """What `make` gives, written once per application and folder of tables."""
    kept = _kept(spark, sf_dir, label)
    if kept is not None:
        return kept
    path = new_path(spark, label)
    make(spark, sf_dir).write.parquet(path)
    _LANDED[spark.sparkContext.applicationId, sf_dir, label] = path
    return spark.read.parquet(path)


def landed(spark: SparkSession, sf_dir: str, columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """The extract as files, like the one the jobs are made for, with only the columns a query needs.

    Every query does its own work on it. Without this, filters on cleaned columns would be pushed into the expressions
    that derive the dirt. Until a query has landed the whole extract, those that need some columns land these alone.
    """
    tune(spark)
    wanted = [c for c in RAW_COLUMNS if c in columns]
    whole = _kept(spark, sf_dir, "landed") if wanted != RAW_COLUMNS else _once(spark, sf_dir, "landed", raw)
    if whole is None:
        label = "-".join(["landed", *(str(RAW_COLUMNS.index(c)) for c in wanted)])
        whole = _once(spark, sf_dir, label, lambda spark, sf_dir: raw(spark, sf_dir).select(*wanted))
    return whole.select(*columns)


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract for a query that writes all of it to files of its own: from the tables, where it is not landed yet."""
    tune(spark)
    whole = _kept(spark, sf_dir, "landed")
    return raw(spark, sf_dir) if whole is None else whole.select(*RAW_COLUMNS)


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract as text lines, joined from its landed columns: no second copy of it is written."""
    return lines.to_lines(landed(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str, profile: str = "datamart", columns: list[str] = RAW_COLUMNS) -> DataFrame:
    return clean(landed(spark, sf_dir, columns), profile, AS_OF)


def datamart(spark: SparkSession, sf_dir: str, columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """The finished table from some raw columns, without imputed prices; the others come out as NULL."""
    return finish(cleaned(spark, sf_dir, "datamart", [*ID_AND_DATE, *[c for c in columns if c not in ID_AND_DATE]]), "datamart")


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.parse_lines(landed_lines(spark, sf_dir))


def clean_table(profile: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    source = parsed_lines if profile == "lines" else landed
    return build_datamart(source(spark, sf_dir), profile, AS_OF)


# -- text, dates, numbers, categories -----------------------------------------------------------------------


def text(profile: str, spark, sf_dir) -> DataFrame:
    return landed(spark, sf_dir).select(*[clean_text(F.col(c), profile).alias(c) for c in TEXT_COLUMNS])


def parsed_dates(profile: str, spark, sf_dir) -> DataFrame:
    columns = ["date", "modified_date"]
    return landed(spark, sf_dir, columns).select(*[dates.parse_date(F.col(c), profile).alias(c) for c in columns])


def parsed_timestamps(profile: str, spark, sf_dir) -> DataFrame:
    return landed(spark, sf_dir, ["timestamp"]).select(dates.parse_timestamp(F.col("timestamp"), profile).alias("ts"))


def free_dates(spark, sf_dir) -> DataFrame:
    """Two columns of mixed layouts, one with the day and one with the month first, settled by their own values."""
    d = F.col("modified_date").try_cast("date")
    kind = F.crc32(F.coalesce("transaction_id", F.col("product_id"))) % 6
    written = lambda f: F.date_format(d, f)
    name = F.element_at(F.array(*map(F.lit, [m for m in list(date_layouts.MONTHS)[12:] if m != "setiembre"])), F.month(d))
    forms = {
        "day_first": ["d/M/yyyy", "dd-MM-yyyy", "d MMMM yyyy", None, "MMM d, yyyy", "dd.MM.yy"],
        "month_first": ["M/d/yyyy", "MM-dd-yy", "yyyy/MM/dd", "yyyyMMdd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy.dd.MM"],
    }
    mixed = landed(spark, sf_dir, ["transaction_id", "product_id", "modified_date"])
    for column, layouts in forms.items():
        text = F.lit(None).cast("string")
        for i, f in enumerate(layouts):
            value = written(f) if f else F.concat(F.dayofmonth(d), F.lit(" de "), name, F.lit(" de "), F.year(d))
            text = F.when(kind == i, value).otherwise(text)
        mixed = mixed.withColumn(column, text)
    return date_layouts.parse_columns(mixed.select(*forms), list(forms))


def anio_mes_sliced(spark, sf_dir) -> DataFrame:
    text_date = strip(F.coalesce(F.col("date"), F.lit("")))
    return landed(spark, sf_dir).select("date", dates.anio_mes_text(text_date).alias("AnioMes"))


def numeric_casts(spark, sf_dir) -> DataFrame:
    doubles = ["unit_price", "total_amount", "discount_pct", "tax_amount"]
    return landed(spark, sf_dir).select(
        numeric.to_long(F.col("quantity")).alias("quantity"),
        numeric.to_double(F.col("quantity")).alias("quantity_float"),
        *[numeric.to_double(F.col(c)).alias(c) for c in doubles],
    )


def quantity_flag(spark, sf_dir) -> DataFrame:
    return landed(spark, sf_dir).select(
        "quantity",
        numeric.null_flag(numeric.to_long(F.col("quantity"))).alias("after_integer_cast"),
        numeric.null_flag(numeric.to_double(F.col("quantity"))).alias("after_float_cast"),
        numeric.null_flag(F.col("quantity")).alias("before_cast"),
    )


def defaults_datamart(spark, sf_dir) -> DataFrame:
    filled = PROFILES["datamart"].columns(F.lit(AS_OF).cast("date"))
    prepared = landed(spark, sf_dir).withColumns(prepare("datamart"))
    return prepared.select(*[filled[c].alias(c) for c in rules.DATAMART_DEFAULTS])


def category(profile: str, column: str, spark, sf_dir) -> DataFrame:
    counted = landed(spark, sf_dir, [column]).groupBy(F.col(column).alias("raw_value")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("raw_value", CATEGORIZERS[profile](F.col("raw_value"), column).alias("label"), "n")


# -- imputation -----------------------------------------------------------------------------------------------


def imputed(profile: str, spark, sf_dir, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    filled = impute(cleaned(spark, sf_dir, profile, PRICE_COLUMNS), PROFILES[profile].imputation, broadcast_bytes)
    return filled.select("transaction_id", *_KEYS, "unit_price", "unit_price_imput", "impute_level")


_KEYS = ["AnioMes", "region", "product_id", "product_category"]


def impute_levels(spark, sf_dir) -> DataFrame:
    rows = imputed("datamart", spark, sf_dir).where(F.col("transaction_id") != rules.UNKNOWN_ID)
    return rows.groupBy("impute_level").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("unit_price_imput"), 6).alias("avg_price")
    )


def impute_one_level(spark, sf_dir) -> DataFrame:
    filled = impute(clean(parsed_lines(spark, sf_dir), "lines", AS_OF), PROFILES["lines"].imputation)
    return filled.select("transaction_id", *_KEYS[:3], "unit_price", "unit_price_imput")


def price_means(level: int, spark, sf_dir) -> DataFrame:
    groups = price_groups(cleaned(spark, sf_dir, "datamart", PRICE_COLUMNS), PROFILES["datamart"].imputation)
    return level_means(groups, level, PROFILES["datamart"].imputation) if level < 4 else global_mean(groups)


def store_refresh(spark, sf_dir) -> DataFrame:
    """Means from stored sums, after the months of one year were corrected and only those were read again."""
    rows = cleaned(spark, sf_dir, "datamart", PRICE_COLUMNS)
    year = F.col("AnioMes").between(199701, 199712)
    table = MonthlyTable(spark, new_path(spark, "monthly"))
    table.replace(rows.withColumn("unit_price", F.when(year, F.col("unit_price") * 2).otherwise(F.col("unit_price"))))
    store = PriceStore(spark, new_path(spark, "price-store"), PROFILES["datamart"].imputation)
    store.refresh(table.read())
    corrected = table.replace(rows.where(year))
    store.refresh(table.read(corrected), corrected)
    return store.means(1)


def store_add(spark, sf_dir) -> DataFrame:
    """Means from stored sums to which the second half of the rows was added later."""
    rows = cleaned(spark, sf_dir, "datamart", PRICE_COLUMNS)
    late = F.crc32(F.coalesce("transaction_id", F.lit(""))) % 2 == 1
    store = PriceStore(spark, new_path(spark, "price-store"), PROFILES["datamart"].imputation)
    store.add(rows.where(~late))
    store.add(rows.where(late))
    return store.means(2)


def update_in_place(spark, sf_dir) -> DataFrame:
    """The price column added to a finished table, and filled in the months that miss prices."""
    table = MonthlyTable(spark, new_path(spark, "monthly"))
    table.replace(cleaned(spark, sf_dir, "external"))
    table.add_column("unit_price_imput", CLEAN_SCHEMA["unit_price_imput"].dataType)
    fills = prepare_fills(table.read(), PROFILES["external"].imputation)
    months = [r[0] for r in fills.table.select("AnioMes").distinct().collect()]
    fill = lambda rows: apply_fills(rows.drop("unit_price_imput"), fills, PROFILES["external"].imputation).drop("impute_level")
    table.rewrite(months, fill)
    return table.read().select("transaction_id", "unit_price", "unit_price_imput", F.col("unit_price_imput").isNotNull().alias("was_filled"))


SKETCHED = ["customer_id", "region", "unit_price"]


def _sketch_store(spark, sf_dir) -> tuple[sketches.SketchStore, DataFrame]:
    """Sketches of which one year's were taken anew from that year's months."""
    rows = datamart(spark, sf_dir, SKETCHED)
    store = sketches.SketchStore(spark, new_path(spark, "sketches"))
    year = F.col("AnioMes").between(199701, 199712)
    store.refresh(rows.withColumn("customer_id", F.when(year, F.lit("nobody")).otherwise(F.col("customer_id"))))
    store.refresh(rows, [199700 + m for m in range(1, 13)])
    return store, rows


def sketch_customers(spark, sf_dir) -> DataFrame:
    """Distinct customers per region, and in all, from merged sketches (exact up to 4096 of them)."""
    held = _sketch_store(spark, sf_dir)[0].sketches()
    columns = ["region", "n_rows", "n_customers"]
    return sketches.figures(held, ["region"]).select(*columns).unionByName(sketches.figures(held, []).withColumn("region", F.lit("*")).select(*columns))


def sketch_kept_customers(spark, sf_dir) -> DataFrame:
    return sketches.kept_customers(_sketch_store(spark, sf_dir)[0].sketches())


def sketch_price_quantiles(spark, sf_dir) -> DataFrame:
    """Per month and region: prices, and whether the sketched 95th percentile has a rank within the stated error."""
    store, rows = _sketch_store(spark, sf_dir)
    found = sketches.figures(store.sketches(), sketches.GROUP).select(*sketches.GROUP, "price")
    # One row per month and region on the right.
    ranked = rows.where("unit_price is not null").join(F.broadcast(found), sketches.GROUP)
    share = lambda hit: F.count_if(hit) / F.count(F.lit(1))
    low, high = share(F.col("unit_price") < F.col("price")), share(F.col("unit_price") <= F.col("price"))
    near = (low <= 0.95 + sketches.RANK_ERROR) & (high >= 0.95 - sketches.RANK_ERROR)
    return ranked.groupBy(*sketches.GROUP).agg(F.count(F.lit(1)).alias("n_prices"), near.alias("near"))


# -- files, sinks, streams --------------------------------------------------------------------------------------


def _csv_copy(spark, sf_dir, compression: str = "none") -> str:
    path = new_path(spark, "csv")
    tables.write_csv(extract(spark, sf_dir), path, compression=compression)
    return path


def csv_roundtrip(spark, sf_dir) -> DataFrame:
    return files.read_csv(spark, _csv_copy(spark, sf_dir))


def _jagged_lines(rows: DataFrame) -> DataFrame:
    """Lines that end two fields early (rows without segment) or bring one too many (rows without status)."""
    cells = [F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS]
    line = (
        F.when(F.col("customer_segment").isNull(), F.concat_ws(",", *cells[:-2]))
        .when(F.col("status").isNull(), F.concat_ws(",", *cells, F.lit("extra")))
        .otherwise(F.concat_ws(",", *cells))
    )
    return rows.select(line.alias("value"))


def csv_jagged(spark, sf_dir) -> DataFrame:
    path = new_path(spark, "jagged")
    _jagged_lines(extract(spark, sf_dir)).write.text(path)
    return files.read_csv(spark, path, header=False)


def csv_corrupt(spark, sf_dir) -> DataFrame:
    """The same kinds of lines, split into usable and marked rows, counted."""
    path = new_path(spark, "corrupt")
    _jagged_lines(extract(spark, sf_dir)).write.text(path)
    good, bad = quality.split_corrupt(files.read_csv(spark, path, keep_corrupt=True, header=False))
    marked = good.select("product_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("product_id", "reason"))
    return marked.groupBy("product_id", "reason").agg(F.count(F.lit(1)).alias("n"))


# Blocks of the compressed copies with quoted line breaks: about 25 MB of text.
SPLIT_BYTES = 8 << 20


def external_view(spark, sf_dir) -> DataFrame:
    """Notes with a line break and quotes, read back through the view."""
    noted = extract(spark, sf_dir).withColumn("notes", F.concat(F.lit('"'), F.col("region"), F.lit('",\n'), F.col("product_id")))
    path = new_path(spark, "external")
    tables.write_csv(noted, path, compression="members")
    return files.external_view(spark, f"{path}/*.gz", block_bytes=SPLIT_BYTES).select("transaction_id", "notes", "modified_date")


def quoted_csv(spark, sf_dir) -> DataFrame:
    """The whole extract with line breaks and quotes in its notes, landed from files that are split all the same."""
    noted = extract(spark, sf_dir).withColumn("notes", F.concat(F.lit('"'), F.coalesce("notes", F.lit("")), F.lit('",\n\n'), F.col("product_id")))
    path = new_path(spark, "quoted")
    tables.write_csv(noted, path, compression="members")
    return files.land_bronze(spark, f"{path}/*.gz", new_path(spark, "bronze"), quoted_newlines=True, block_bytes=SPLIT_BYTES)


def gzip_chain(spark, sf_dir) -> DataFrame:
    """The whole extract in gzip files of many members, each read by several tasks."""
    path = new_path(spark, "members")
    gzip_members.write_members(extract(spark, sf_dir), path, member_rows=2000)
    return files.read_gzip_csv(spark, path, block_bytes=200_000)


def bronze(spark, sf_dir) -> DataFrame:
    return files.land_bronze(spark, _csv_copy(spark, sf_dir, "gzip"), new_path(spark, "bronze"))


def lines_parse(spark, sf_dir) -> DataFrame:
    return lines.parse_lines(landed_lines(spark, sf_dir))


def lines_file(spark, sf_dir) -> DataFrame:
    """The lines written as text files, one of them a header, and read back."""
    path = new_path(spark, "lines-file")
    lines.to_lines(extract(spark, sf_dir)).write.text(path)
    spark.createDataFrame([(",".join(RAW_COLUMNS),)], "value string").write.mode("append").text(path)
    return lines.parse_lines(lines.read_lines(spark, path))


def lines_text(spark, sf_dir) -> DataFrame:
    return lines.clean_lines(landed_lines(spark, sf_dir))


def line_reject_rows(spark, sf_dir) -> DataFrame:
    """Lines cut short where the segment is missing, and whether they are usable."""
    cells = [F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS]
    line = F.when(F.col("customer_segment").isNull(), F.concat_ws(",", *cells[:15])).otherwise(F.concat_ws(",", *cells))
    good, bad = quality.split_line_rejects(landed(spark, sf_dir).select(line.alias("value")))
    return good.withColumn("reason", F.lit("ok")).unionByName(bad)


def line_rejects(spark, sf_dir) -> DataFrame:
    """How many of these lines are usable."""
    return line_reject_rows(spark, sf_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars"))


def schema_evolution(spark, sf_dir) -> DataFrame:
    """A load without `notes`, then one that brings it."""
    rows = datamart(spark, sf_dir, ["notes"]).select("transaction_id", "AnioMes", "notes")
    path = new_path(spark, "evolved")
    early = F.col("AnioMes") < 199901
    tables.append_evolving(rows.where(early).drop("notes"), path)
    tables.append_evolving(rows.where(~early), path)
    return files.read_table(spark, path, merge_schema=True).select("transaction_id", "AnioMes", "notes")


def column_merge(spark, sf_dir) -> DataFrame:
    rows = datamart(spark, sf_dir, ["region", "notes"]).select("transaction_id", "AnioMes", "region", "notes")
    early = F.col("AnioMes") < 199901
    return tables.merge_columns(rows.where(early).drop("notes"), rows.where(~early).drop("region"))


def parquet_overwrite(spark, sf_dir) -> DataFrame:
    """A partial load replaced by a full one, partitioned by month."""
    rows = datamart(spark, sf_dir).drop("unit_price_imput")
    path = new_path(spark, "datamart")
    tables.write_parquet(rows.where(F.col("AnioMes") < 199901), path)
    tables.write_parquet(rows, path, by_month=True)
    return files.read_table(spark, path, CLEAN_SCHEMA).drop("unit_price_imput")


def dual_write(spark, sf_dir) -> DataFrame:
    paths = [new_path(spark, "main"), new_path(spark, "mart")]
    tables.write_both(datamart(spark, sf_dir), paths)
    both = [files.read_table(spark, p).withColumn("target", F.lit(i)) for i, p in enumerate(paths)]
    return tables.merge_columns(*both).groupBy("target", "AnioMes").agg(
        F.count(F.lit(1)).alias("n"), numeric.exact_sum(F.col("total_amount")).alias("revenue")
    )


def table_replace(spark, sf_dir) -> DataFrame:
    """An earlier, smaller version replaced by the whole."""
    rows = datamart(spark, sf_dir, ["region", "quantity"]).select("transaction_id", "date", "region", "quantity")
    path = new_path(spark, "table")
    name = "salesmill_" + path.rsplit("-", 1)[1]
    tables.create_or_replace_table(rows.where(F.year("date") < 1999), name, path)
    return tables.create_or_replace_table(rows, name, path)


def add_column(spark, sf_dir) -> DataFrame:
    """The price column added to a finished table by a rewrite."""
    source, target = new_path(spark, "before"), new_path(spark, "after")
    cleaned(spark, sf_dir, "external").write.parquet(source)
    filled = impute(spark.read.parquet(source), PROFILES["external"].imputation)
    tables.write_parquet(filled, target)
    flagged = tables.add_column(spark, target, new_path(spark, "flagged"), "was_filled", F.col("unit_price_imput").isNotNull())
    return flagged.select("transaction_id", "unit_price", "unit_price_imput", "was_filled")


def text_sink(spark, sf_dir) -> DataFrame:
    rows = clean(parsed_lines(spark, sf_dir), "lines", AS_OF)
    path = new_path(spark, "text")
    tables.write_text(rows.select("transaction_id", "date", "customer_id", "AnioMes", "quantity_null"), path)
    return spark.read.text(path)


def stream_append(spark, sf_dir) -> DataFrame:
    source, target = _csv_copy(spark, sf_dir, "gzip"), new_path(spark, "stream")
    stream_clean(spark, source, target, new_path(spark, "stream-state"), "microbatch", AS_OF).awaitTermination()
    return spark.read.schema(CLEAN_SCHEMA).parquet(target)


def stream_filled(spark, sf_dir) -> DataFrame:
    source, target = _csv_copy(spark, sf_dir, "gzip"), new_path(spark, "stream")
    p = PROFILES["datamart"]
    fills = prepare_fills(clean(files.read_csv(spark, source), p, AS_OF), p.imputation)
    rows = clean(files.stream_csv(spark, source), p, AS_OF)
    stream_impute(rows, fills, target, new_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(CLEAN_SCHEMA).parquet(target + "/batch=*")


def _moving_fills(spark, sf_dir, files_per_trigger: int | None) -> tuple[PriceStore, str]:
    source, target = _csv_copy(spark, sf_dir, "gzip"), new_path(spark, "stream")
    p = PROFILES["datamart"]
    store = PriceStore(spark, new_path(spark, "price-store"), p.imputation)
    rows = clean(files.stream_csv(spark, source, files_per_trigger), p, AS_OF)
    stream_moving_fills(rows, store, target, new_path(spark, "stream-state")).awaitTermination()
    return store, target


def stream_moving_rows(spark, sf_dir) -> DataFrame:
    """Rows filled by means that move with the stream; all files make one batch, so those of the batch job."""
    return spark.read.schema(CLEAN_SCHEMA).parquet(_moving_fills(spark, sf_dir, None)[1] + "/batch=*")


def stream_moving_means(spark, sf_dir) -> DataFrame:
    """The means after several batches: those of one run over all their rows."""
    return _moving_fills(spark, sf_dir, 3)[0].means(2)


def stream_monthly(spark, sf_dir) -> DataFrame:
    """Totals and distinct customers per calendar month of a stream."""
    source, target = _csv_copy(spark, sf_dir, "gzip"), new_path(spark, "stream")
    rows = finish(clean(files.stream_csv(spark, source), "datamart", AS_OF), "datamart")
    stream_totals(customer_months(rows), target, new_path(spark, "stream-state")).awaitTermination()
    return monthly_totals(spark, target)


def stream_windows(spark, sf_dir) -> DataFrame:
    """Event-time totals, the last state of each window kept."""
    source, target = _csv_copy(spark, sf_dir, "gzip"), new_path(spark, "stream")
    windows = monthly_windows(clean(files.stream_csv(spark, source), "datamart", AS_OF))
    stream_totals(windows, target, new_path(spark, "stream-state")).awaitTermination()
    return latest_totals(spark, target)


def stream_rejects(spark, sf_dir) -> DataFrame:
    """Lines with a wrong field count that a cleaning stream set aside; the others it cleaned, counted."""
    source, target, rejects = new_path(spark, "jagged"), new_path(spark, "stream"), new_path(spark, "rejects")
    _jagged_lines(extract(spark, sf_dir)).write.text(source)
    stream_split(spark, source, target, rejects, new_path(spark, "stream-state"), "microbatch", AS_OF, header=False).awaitTermination()
    cleaned_rows = spark.read.schema(CLEAN_SCHEMA).parquet(target + "/batch=*").agg(F.count(F.lit(1)).alias("n_clean"))
    bad = spark.read.parquet(rejects).select(*RAW_COLUMNS, "reason")
    return bad.join(F.broadcast(cleaned_rows))  # one row


def stream_progress(spark, sf_dir) -> DataFrame:
    """The counts that a stream recorded, batch by batch, over two runs."""
    source, target, rejects, progress = (new_path(spark, x) for x in ("jagged", "stream", "rejects", "progress"))
    state, rows = new_path(spark, "stream-state"), landed(spark, sf_dir)
    late = F.crc32(F.coalesce("transaction_id", F.lit(""))) % 2 == 1
    for part in (rows.where(~late), rows.where(late)):
        _jagged_lines(part).write.mode("append").text(source)
        stream_split(spark, source, target, rejects, state, "datamart", AS_OF, header=False, progress=progress).awaitTermination()
    return total_progress(spark, progress)


def job_stats(spark, sf_dir) -> DataFrame:
    """The whole job from compressed files to two targets: its report, and the same of the second target."""
    targets = [new_path(spark, "main"), new_path(spark, "mart")]
    first = run_job(spark, _csv_copy(spark, sf_dir, "gzip"), targets, "datamart", AS_OF)
    second = table_stats(files.read_table(spark, targets[1], CLEAN_SCHEMA), "pipeline")
    return first.withColumn("target", F.lit(0)).unionByName(second.withColumn("target", F.lit(1)))


# -- quality, samples -------------------------------------------------------------------------------------------


def quality_figures(spark, sf_dir) -> DataFrame:
    rows = landed(spark, sf_dir)
    return quality.quality_figures(rows, build_datamart(rows, "datamart", AS_OF))


def rejects(spark, sf_dir) -> DataFrame:
    return quality.split_rejects(landed(spark, sf_dir))[1]


def schema_report(spark, sf_dir) -> DataFrame:
    """The raw extract held against the clean schema."""
    return quality.check_schema(landed(spark, sf_dir), CLEAN_SCHEMA)


def recent_window(spark, sf_dir) -> DataFrame:
    rows = dashboard.recent(datamart(spark, sf_dir, ["total_amount"]), AS_OF)
    return rows.select("transaction_id", "date", "AnioMes", "total_amount")


def sample_n(spark, sf_dir) -> DataFrame:
    return sample_rows(stage(datamart(spark, sf_dir), "datamart"), 10_000)


def sample_facts(rows: DataFrame, n: int) -> DataFrame:
    """What must hold of any random sample of `n` rows: its size, its distinct rows, and those found in the table."""
    numbered = stage(rows.select("transaction_id", "date", F.monotonically_increasing_id().alias("row_no")), "numbered")
    sample = stage(sample_rows(numbered, n), "sample")
    known = sample.join(numbered.select("row_no", F.col("transaction_id").alias("known_id")), "row_no", "left")
    return known.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_no").alias("n_distinct"),
        F.count_if(F.col("known_id") == F.col("transaction_id")).alias("n_members"),
    )


def sample_n_facts(spark, sf_dir) -> DataFrame:
    return sample_facts(datamart(spark, sf_dir), 10_000)


def dashboard_sample(spark, sf_dir) -> DataFrame:
    """The dashboard's own load: the last 60 days, and of these at most 100,000 random rows."""
    return sample_facts(dashboard.recent(datamart(spark, sf_dir), AS_OF), 100_000)


def sample_months(spark, sf_dir) -> DataFrame:
    """Per month and region, what must hold of a sample of 50 rows: its size, its distinct rows, and those of that group."""
    groups = ["AnioMes", "region"]
    rows = datamart(spark, sf_dir, ["region"]).select("transaction_id", *groups, F.monotonically_increasing_id().alias("row_no"))
    numbered = stage(rows, "numbered")
    sample = stage(sample_strata(numbered, 50, groups), "sample")
    known = sample.join(numbered.select("row_no", *[F.col(g).alias(f"own_{g}") for g in groups]), "row_no")
    own = (F.col("AnioMes") == F.col("own_AnioMes")) & F.col("region").eqNullSafe(F.col("own_region"))
    return known.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_no").alias("n_distinct"), F.count_if(own).alias("n_members")
    )


def over_datamart(report: Callable[[DataFrame], DataFrame], columns: list[str], spark, sf_dir) -> DataFrame:
    return report(datamart(spark, sf_dir, columns))


def over_full(report: Callable[[DataFrame], DataFrame], spark, sf_dir) -> DataFrame:
    return report(clean_table("datamart", spark, sf_dir))


def cached_monthly(spark, sf_dir) -> DataFrame:
    """A dashboard result asked for twice: the second answer is the kept one."""
    cache = ResultCache(spark, folder=new_path(spark, "results"))
    for _ in range(2):
        answer = cache.get(dashboard.monthly(datamart(spark, sf_dir, ["customer_id", *SALES])))
    return answer


def named_columns(spark, sf_dir) -> DataFrame:
    """A cleaner over those of the named columns that the extract has."""
    named = [*TEXT_COLUMNS, "absent"]
    return clean_columns(landed(spark, sf_dir, TEXT_COLUMNS), named, lambda c: clean_text(c, "chunked"))


def stats(flavour: str, spark, sf_dir) -> DataFrame:
    if flavour == "external":
        return table_stats(cleaned(spark, sf_dir, "external", ID_AND_DATE + STATS_COLUMNS), flavour)
    return table_stats(datamart(spark, sf_dir, STATS_COLUMNS), flavour)


STATS_COLUMNS = ["customer_id", "product_id", "region", "quantity", "unit_price", "total_amount"]
SALES = ["total_amount", "quantity"]


def _queries() -> dict[str, Query]:
    q: dict[str, Query] = {f"{p}_clean": partial(clean_table, p) for p in PROFILES}
    q |= {f"text_{p}": partial(text, p) for p in PROFILES}
    q |= {f"dates_{p}": partial(parsed_dates, p) for p in DATE_PROFILES}
    q |= {f"timestamps_{p}": partial(parsed_timestamps, p) for p in DATE_PROFILES}
    q |= {
        "anio_mes_sliced": anio_mes_sliced,
        "free_dates": free_dates,
        "numeric_casts": numeric_casts,
        "quantity_flag": quantity_flag,
        "defaults_datamart": defaults_datamart,
    }
    q |= {f"cat_{c}_{p}": partial(category, p, c) for p, columns in CATEGORY_COLUMNS.items() for c in columns}
    q |= {
        "impute_levels": impute_levels,
        "impute_datamart": partial(imputed, "datamart"),
        "impute_shuffled": partial(imputed, "datamart", broadcast_bytes=0),
        "impute_nulls_only": partial(imputed, "external"),
        "impute_chunked": partial(imputed, "chunked"),
        "impute_one_level": impute_one_level,
        "price_means_product": partial(price_means, 1),
        "price_means_category": partial(price_means, 2),
        "price_means_region": partial(price_means, 3),
        "price_mean_global": partial(price_means, 4),
    }
    q |= {f"stats_{f}": partial(stats, f) for f in ["external", "pipeline", "short", "smoke", "count"]}
    q |= {
        "eda_kpis": partial(over_datamart, dashboard.kpis, STATS_COLUMNS),
        "eda_null_profile": partial(over_full, dashboard.null_profile),
        "eda_types": partial(over_full, dashboard.column_types),
        "eda_regions": partial(over_datamart, dashboard.by_region, ["region"]),
        "eda_monthly": partial(over_datamart, dashboard.monthly, ["customer_id", *SALES]),
        "eda_categories": partial(over_datamart, dashboard.by_category, ["product_category", *SALES]),
        "eda_top_products": partial(over_datamart, dashboard.top_products, ["product_id", *SALES]),
        "eda_lifecycle": partial(over_datamart, dashboard.by_lifecycle, ["product_lifecycle", *SALES]),
        "eda_segments": partial(over_datamart, dashboard.by_segment, ["customer_segment", "customer_id", *SALES]),
        "eda_top_customers": partial(over_datamart, dashboard.top_customers, ["customer_id", *SALES]),
        "eda_payments": partial(over_datamart, dashboard.by_payment, ["payment_method", *SALES]),
        "eda_financial": partial(over_datamart, dashboard.financial, ["total_amount", "discount_pct", "tax_amount"]),
        "eda_price_hist": partial(over_datamart, dashboard.price_histogram, ["unit_price"]),
        "eda_discount_hist": partial(over_datamart, dashboard.discount_histogram, ["discount_pct"]),
        "eda_price_by_region": partial(over_datamart, dashboard.price_by_region, ["region", "unit_price"]),
        "eda_discount_by_category": partial(over_datamart, dashboard.discount_by_category, ["product_category", "discount_pct"]),
        "eda_region_profit": partial(over_datamart, dashboard.region_profit, ["region", *SALES]),
        "eda_price_p95": partial(over_datamart, dashboard.price_p95, ["unit_price"]),
        "cached_monthly": cached_monthly,
        "named_columns": named_columns,
        "recent_window": recent_window,
        "sample_n": sample_n,
        "sample_n_facts": sample_n_facts,
        "dashboard_sample": dashboard_sample,
        "sample_months": sample_months,
        "job_stats": job_stats,
        "lines_file": lines_file,
        "line_reject_rows": line_reject_rows,
        "stream_rejects": stream_rejects,
        "csv_roundtrip": csv_roundtrip,
        "csv_jagged": csv_jagged,
        "csv_corrupt": csv_corrupt,
        "external_view": external_view,
        "bronze": bronze,
        "quoted_csv": quoted_csv,
        "gzip_chain": gzip_chain,
        "lines_parse": lines_parse,
        "lines_text": lines_text,
        "line_rejects": line_rejects,
        "schema_evolution": schema_evolution,
        "column_merge": column_merge,
        "parquet_overwrite": parquet_overwrite,
        "dual_write": dual_write,
        "table_replace": table_replace,
        "add_column": add_column,
        "text_sink": text_sink,
        "stream_append": stream_append,
        "stream_filled": stream_filled,
        "stream_windows": stream_windows,
        "stream_moving_rows": stream_moving_rows,
        "stream_moving_means": stream_moving_means,
        "stream_monthly": stream_monthly,
        "stream_progress": stream_progress,
        "store_refresh": store_refresh,
        "store_add": store_add,
        "update_in_place": update_in_place,
        "sketch_customers": sketch_customers,
        "sketch_kept_customers": sketch_kept_customers,
        "sketch_price_quantiles": sketch_price_quantiles,
        "quality_figures": quality_figures,
        "rejects": rejects,
        "schema_report": schema_report,
    }
    return q


QUERIES = _queries()
