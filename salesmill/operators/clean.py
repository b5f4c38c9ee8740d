"""Row-wise cleaning: one narrow projection over the raw columns, the same for batch and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from salesmill.functions import rules
from salesmill.plans.profiles import Profile, get_profile, prepare
from salesmill.schemas import RAW_COLUMNS

# Set where a missing price may be filled; dropped by the final projection.
PRICE_MISSING = "_price_missing"


def as_of_column(as_of: dt.date | str | Column | None) -> Column:
    """The day that stands for "today"; pass one to make a run repeatable."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def clean_columns(df: DataFrame, columns: list[str], cleaner) -> DataFrame:
    """Apply a column function to those of `columns` that `df` has."""
    return df.withColumns({c: cleaner(F.col(c)) for c in columns if c in df.columns})


def clean(df: DataFrame, profile: str | Profile, as_of=None) -> DataFrame:
    """Raw text rows to typed rows plus `AnioMes`, `quantity_null` and the internal price mark.

    Columns the input lacks come out as NULL. Rows without an id or a readable date are dropped where the
    profile says so; `split_rejects` keeps them.
    """
    p = get_profile(profile)
    exprs = p.columns(as_of_column(as_of))
    have = set(df.columns)
    raw = {c: F.col(c) if c in have else F.lit(None).cast("string") for c in RAW_COLUMNS}
    rows = df.where(F.col("transaction_id").isNotNull()) if p.require_id else df
    tidy = prepare(p.name)
    rows = rows.select(*[(tidy[c] if c in have and c in tidy else raw[c]).alias(c) for c in RAW_COLUMNS])
    value = {c: exprs.get(c, F.col(c)) if c in have else F.col(c) for c in RAW_COLUMNS}
    typed = rows.select(
        *[value[c].try_cast(p.schema[c].dataType).alias(c) for c in RAW_COLUMNS],
        *[F.col(c).alias(f"_raw_{c}") for c in ("quantity", "unit_price")],
    )
    if p.require_date:
        typed = typed.where(F.col("date").isNotNull())
    # A projection of its own: it reads the casts and parses above instead of repeating them.
    return typed.withColumns(
        {
            "AnioMes": p.anio_mes(F.col("date")),
            "quantity_null": p.quantity_missing(F.col("_raw_quantity"), F.col("quantity")).cast("int"),
            PRICE_MISSING: p.price_missing(F.col("_raw_unit_price"), F.col("unit_price")),
        }
    ).drop("_raw_quantity", "_raw_unit_price")


def finish(df: DataFrame, profile: str | Profile) -> DataFrame:
    """Last step, after imputation: drop placeholder ids and project the output columns in their order."""
    p = get_profile(profile)
    if p.drop_unknown_id:
        df = df.where(F.col("transaction_id") != rules.UNKNOWN_ID)
    have = set(df.columns)
    return df.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in p.schema.fields
        ]
    )
