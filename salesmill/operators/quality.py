"""Data quality: figures, schema report, and the rows or values a profile could not use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from salesmill.functions.dates import date_text, date_value
from salesmill.functions.numeric import to_double, to_long
from salesmill.plans.profiles import get_profile
from salesmill.schemas import NUMERIC_COLUMNS, RAW_COLUMNS, RAW_SCHEMA
from salesmill.sources.lines import MIN_FIELDS, n_fields


def quality_figures(raw: DataFrame, clean: DataFrame, profile: str = "datamart") -> DataFrame:
    """One row: counts and percentages of rows kept, dates read, and missing prices filled.

    `clean` is the finished table of `raw`; one narrow aggregate over each.
    """
    given = F.col("date").isNotNull() & (F.trim("date") != "")
    read = date_value(date_text(F.col("date"), profile), profile).isNotNull()
    before = raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(given).alias("dates_given"),
        F.count_if(given & read).alias("dates_read"),
    )
    missing = F.col("unit_price").isNull()
    after = clean.agg(
        F.count(F.lit(1)).alias("clean_rows"),
        F.count_if(missing).alias("prices_missing"),
        F.count_if(missing & F.col("unit_price_imput").isNotNull()).alias("prices_filled"),
    )
    columns = before.columns + after.columns
    one = before.unionByName(after, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in columns])
    pct = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole) * 100)
    return one.select(
        *columns,
        pct("clean_rows", "raw_rows").alias("pct_rows_kept"),
        pct("dates_read", "dates_given").alias("pct_dates_read"),
        pct("prices_filled", "prices_missing").alias("pct_prices_filled"),
    )


def check_schema(df: DataFrame, expected: T.StructType = RAW_SCHEMA) -> DataFrame:
    """One row per expected column: its type, what `df` has, whether they agree, and its non-null values."""
    actual = dict(df.dtypes)
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    counted = df.agg(*[(F.count(c) if c in actual else F.lit(0)).cast("long").alias(c) for c in wanted])
    as_map = lambda d: F.create_map(*[F.lit(x) for pair in d.items() for x in pair])
    present = {c: actual[c] for c in wanted if c in actual}
    found = F.try_element_at(as_map(present), F.col("column")) if present else F.lit(None).cast("string")
    rows = counted.unpivot([], list(wanted), "column", "n_values")
    return rows.select("column", as_map(wanted)[F.col("column")].alias("expected"), found.alias("actual"), "n_values").withColumn(
        "ok", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False))
    )


def reject_reason(profile: str = "datamart") -> Column:
    """First thing wrong with a raw row, or NULL: its id, its date, or a value that is no number."""
    p = get_profile(profile)
    reason = F.when(F.col("transaction_id").isNull(), "null_id")
    read = date_value(date_text(F.col("date"), p.name), p.name)
    reason = reason.when(read.isNull(), "bad_date")
    for c in NUMERIC_COLUMNS:
        number = to_long(F.col(c)) if c == "quantity" and p.require_date else to_double(F.col(c))
        reason = reason.when(F.col(c).isNotNull() & (F.trim(c) != "") & number.isNull(), f"bad_{c}")
    return reason


def split_rejects(raw: DataFrame, profile: str = "datamart") -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows with their `reason`); together they are all rows of `raw`."""
    marked = raw.withColumn("reason", reject_reason(profile))
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def split_line_rejects(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines with enough fields, the others with their `reason`)."""
    short = F.coalesce(n_fields(F.col("value")) < MIN_FIELDS, F.lit(True))
    return lines.where(~short), lines.where(short).withColumn("reason", F.lit("short_row"))


def split_corrupt(df: DataFrame, column: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, rows the CSV reader marked), for input read with `keep_corrupt`.

    The reason tells a row with too few fields from one with too many; commas inside quotes are no separators.
    """
    bad = F.col(column).isNotNull()
    n_fields = F.length(F.regexp_replace(F.regexp_replace(column, '"[^"]*"', ""), "[^,]", "")) + 1
    wanted = len(RAW_COLUMNS)
    reason = F.when(n_fields < wanted, "short_row").when(n_fields > wanted, "long_row").otherwise("malformed_row")
    return df.where(~bad).drop(column), df.where(bad).select(*RAW_COLUMNS, column, reason.alias("reason"))
