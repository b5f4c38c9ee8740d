"""Comma-split text lines: the record form and the text-only form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmill.functions.text import replace_all, strip
from salesmill.schemas import RAW_COLUMNS

# Fewest fields of a usable line; fields 1, 8 and 9 are date, quantity and price.
MIN_FIELDS = 20
DATE_FIELD, QUANTITY_FIELD, PRICE_FIELD = 1, 8, 9


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines without the CSV header, which the first column name gives away."""
    return spark.read.text(path).where(~F.col("value").startswith(RAW_COLUMNS[0] + ","))


def to_lines(raw: DataFrame) -> DataFrame:
    """Raw rows as plain comma-joined lines, NULL as an empty field."""
    return raw.select(F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in RAW_COLUMNS]).alias("value"))


def n_fields(line: Column) -> Column:
    """How many fields commas cut a line into, without cutting it."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(","), F.lit(""))) + 1


def _fields(lines: DataFrame) -> DataFrame:
    """The fields of usable lines as one array `f`; lines are cut after the others are left out."""
    return lines.where(n_fields(F.col("value")) >= MIN_FIELDS).select(F.split("value", ",").alias("f"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines to raw rows: split on every comma, trim, last field optional; short lines are left out."""
    fields = _fields(lines)
    last = len(RAW_COLUMNS) - 1
    return fields.select(
        *[strip(F.get("f", F.lit(i))).alias(c) for i, c in enumerate(RAW_COLUMNS[:last])],
        strip(F.coalesce(F.get("f", F.lit(last)), F.lit(""))).alias(RAW_COLUMNS[last]),
    )


def _line_month(date: Column) -> Column:
    month = F.when(F.length(date) >= 7, F.substring(date, 6, 2)).otherwise(F.lit("01"))
    return F.when(F.length(date) >= 4, F.concat(F.substring(date, 1, 4), month)).otherwise(F.lit(""))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Lines to lines: every field repaired, then month, missing-quantity flag and price appended as text."""
    fields = _fields(lines).select(F.transform("f", lambda x: replace_all(strip(x), "lines")).alias("f"))
    date, quantity, price = [F.get("f", F.lit(i)) for i in (DATE_FIELD, QUANTITY_FIELD, PRICE_FIELD)]
    is_blank = lambda c: strip(c) == ""
    return fields.select(
        F.concat_ws(
            ",",
            "f",
            _line_month(strip(date)),
            F.when(is_blank(quantity), "1").otherwise("0"),
            F.when(is_blank(price), "").otherwise(price),
        ).alias("value")
    )
