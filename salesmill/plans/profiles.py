"""The five cleaning profiles: for every output column, the expression that makes it from the raw row.

Profiles share all machinery and differ only in these tables, so `operators.clean` has one code path.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from salesmill.functions import dates, numeric, rules
from salesmill.functions.categories import CATEGORY_COLUMNS, CATEGORIZERS, microbatch_key, microbatch_label
from salesmill.functions.text import finish_text, repair_text, strip
from salesmill.schemas import CLEAN_SCHEMA, DATE_COLUMNS, LINES_SCHEMA, NUMERIC_COLUMNS


@dataclass(frozen=True)
class Imputation:
    """How missing prices are filled.

    `levels` counts the group means tried in turn, the last of four being the mean over the whole table.
    `null_safe` lists the key columns on which NULL is a group of its own; on the others NULL matches
    nothing. `only_missing` leaves the result NULL where the price was present. `skip_blank` keeps blank
    keys and zero prices out of the means.
    """

    levels: int = 4
    null_safe: tuple[str, ...] = ()
    only_missing: bool = False
    skip_blank: bool = False


@dataclass(frozen=True)
class Profile:
    name: str
    columns: Callable[[Column], dict[str, Column]]
    schema: T.StructType = CLEAN_SCHEMA
    require_id: bool = False
    require_date: bool = False
    drop_unknown_id: bool = False
    anio_mes: Callable[[Column], Column] = dates.anio_mes
    quantity_missing: Callable[[Column, Column], Column] = lambda raw, value: value.isNull()
    price_missing: Callable[[Column, Column], Column] = lambda raw, value: value.isNull()
    imputation: Imputation | None = None


def _text(columns: list[str], profile: str) -> dict[str, Column]:
    """Text columns that `prepare` has repaired."""
    return {c: finish_text(F.col(c), profile) for c in columns}


def _categories(profile: str) -> dict[str, Column]:
    return {c: CATEGORIZERS[profile](F.col(c), c) for c in CATEGORY_COLUMNS[profile]}


def _doubles(columns: list[str]) -> dict[str, Column]:
    return {c: numeric.to_double(F.col(c)) for c in columns}


def _integer_quantity() -> dict[str, Column]:
    return {"quantity": numeric.to_long(F.col("quantity")), **_doubles(NUMERIC_COLUMNS[1:])}


def _dates(profile: str, as_of: Column) -> dict[str, Column]:
    """The three date columns, from text that `prepare` has tidied."""
    return {
        "date": dates.date_value(F.col("date"), profile),
        "timestamp": dates.timestamp_value(F.col("timestamp"), profile),
        "modified_date": dates.modified_date_value(F.col("modified_date"), profile, as_of),
    }


def _unreadable(raw: Column, value: Column) -> Column:
    """Missing means absent or not a number; an empty field of a line counts as present."""
    return value.isNull() & (raw.isNull() | (raw != ""))


# The columns each profile repairs as free text.
DATAMART_TEXT = ["customer_id", "product_id", "warehouse", "notes", "created_by"]
EXTERNAL_TEXT = ["transaction_id"] + DATAMART_TEXT
CHUNKED_TEXT = [
    "customer_id", "customer_segment", "product_id", "product_category", "product_lifecycle", "currency",
    "region", "warehouse", "status", "payment_method", "notes", "created_by",
]
MICROBATCH_TEXT = ["transaction_id", "customer_id", "product_id", "warehouse", "notes", "created_by"]


def datamart_columns(as_of: Column) -> dict[str, Column]:
    text = {"transaction_id": strip(F.col("transaction_id")), **_text(TEXT["datamart"], "datamart")}
    return {
        **{c: F.coalesce(e, F.lit(rules.DATAMART_DEFAULTS[c])) for c, e in text.items()},
        **_categories("datamart"),
        **_integer_quantity(),
        **_dates("datamart", as_of),
    }


def external_columns(as_of: Column) -> dict[str, Column]:
    return {
        **_text(TEXT["external"], "external"),
        **_categories("external"),
        **_integer_quantity(),
        **_dates("external", as_of),
    }


def chunked_columns(as_of: Column) -> dict[str, Column]:
    return {
        **_text(TEXT["chunked"], "chunked"),
        **_doubles(NUMERIC_COLUMNS),
        **_dates("chunked", as_of),
    }


def microbatch_columns(as_of: Column) -> dict[str, Column]:
    return {
        **_text(TEXT["microbatch"], "microbatch"),
        **_categories("microbatch"),
        **{c: microbatch_label(F.col(c), c) for c in rules.MICROBATCH_CATEGORIES},
        **_doubles(NUMERIC_COLUMNS),
        **_dates("microbatch", as_of),
    }


def lines_columns(as_of: Column) -> dict[str, Column]:
    return {
        **_text(TEXT["lines"], "lines"),
        **_doubles(NUMERIC_COLUMNS),
    }


# What each profile repairs as text; the other columns are normalized, parsed, cast or left as they are.
TEXT = {
    "datamart": DATAMART_TEXT, "external": EXTERNAL_TEXT, "chunked": CHUNKED_TEXT,
    "microbatch": MICROBATCH_TEXT, "lines": CHUNKED_TEXT,
}


def prepare(profile: str) -> dict[str, Column]:
    """Columns to tidy in a projection of their own, before `columns` reads them several times each.

    The modification date of `datamart` has no eight-digit form, so it is only trimmed.
    """
    columns = ["date", "modified_date"] if profile == "lines" else DATE_COLUMNS
    tidy = {c: dates.date_text(F.col(c), profile) for c in columns}
    tidy |= {c: repair_text(F.col(c), profile) for c in TEXT[profile]}
    if profile == "datamart":
        tidy["modified_date"] = strip(F.col("modified_date"))
    if profile == "microbatch":
        tidy |= {c: microbatch_key(F.col(c)) for c in rules.MICROBATCH_CATEGORIES}
    return tidy


PROFILES = {
    p.name: p
    for p in [
        Profile(
            "datamart", datamart_columns, require_id=True, require_date=True, drop_unknown_id=True,
            imputation=Imputation(null_safe=("AnioMes", "region", "product_id", "product_category")),
        ),
        Profile(
            "external", external_columns, require_id=True, require_date=True,
            imputation=Imputation(only_missing=True),
        ),
        Profile(
            "chunked", chunked_columns,
            imputation=Imputation(null_safe=("region", "product_id", "product_category")),
        ),
        Profile("microbatch", microbatch_columns, quantity_missing=lambda raw, value: raw.isNull()),
        Profile(
            "lines", lines_columns, schema=LINES_SCHEMA, anio_mes=dates.anio_mes_text,
            quantity_missing=_unreadable, price_missing=_unreadable,
            imputation=Imputation(levels=1, skip_blank=True),
        ),
    ]
}


def get_profile(profile: str | Profile) -> Profile:
    if isinstance(profile, Profile):
        return profile
    try:
        return PROFILES[profile]
    except KeyError:
        raise ValueError(f"unknown profile {profile!r}; known: {', '.join(PROFILES)}") from None
