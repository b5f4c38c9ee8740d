"""Column contracts of the raw extract and of the clean datamart."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T, functions as F

# The 21 raw column names, in extract order.
RAW_COLUMNS = [
    "transaction_id", "date", "timestamp", "customer_id", "customer_segment",
    "product_id", "product_category", "product_lifecycle", "quantity", "unit_price",
    "total_amount", "currency", "region", "warehouse", "status", "payment_method",
    "discount_pct", "tax_amount", "notes", "created_by", "modified_date",
]

# Spark types of the columns that do not stay text in the clean table.
CLEAN_TYPES = {
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "quantity": T.LongType(),
    "unit_price": T.DoubleType(),
    "total_amount": T.DoubleType(),
    "discount_pct": T.DoubleType(),
    "tax_amount": T.DoubleType(),
    "modified_date": T.DateType(),
    "AnioMes": T.IntegerType(),
    "quantity_null": T.IntegerType(),
    "unit_price_imput": T.DoubleType(),
}

DERIVED_COLUMNS = ["AnioMes", "quantity_null", "unit_price_imput"]
NUMERIC_COLUMNS = ["quantity", "unit_price", "total_amount", "discount_pct", "tax_amount"]
DATE_COLUMNS = ["date", "timestamp", "modified_date"]
TEXT_COLUMNS = [c for c in RAW_COLUMNS if c not in CLEAN_TYPES]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

CLEAN_SCHEMA = T.StructType(
    [T.StructField(c, CLEAN_TYPES.get(c, T.StringType())) for c in RAW_COLUMNS + DERIVED_COLUMNS]
)

# The `lines` profile never parses its dates, so they stay text; its quantity is a float.
LINES_SCHEMA = T.StructType(
    [
        T.StructField(
            f.name,
            T.StringType() if f.name in DATE_COLUMNS
            else T.DoubleType() if f.name == "quantity" else f.dataType,
        )
        for f in CLEAN_SCHEMA.fields
    ]
)


def conform(df: DataFrame, schema: T.StructType = CLEAN_SCHEMA) -> DataFrame:
    """Project to exactly `schema`: its order, its types, absent columns as NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
