"""Declared table shapes: strings as landed (Bronze), typed and keyed (Silver)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INGEST_TS = "_ingest_ts"
UPDATED_TS = "_updated_ts"


def _landing(*columns: str) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    return T.StructType([*fields, T.StructField(INGEST_TS, T.TimestampType())])


BRONZE: dict[str, T.StructType] = {
    "bronze_customers": _landing(
        "customer_id", "first_name", "last_name", "email", "phone", "created_at"
    ),
    "bronze_products": _landing(
        "product_id", "sku", "product_name", "category", "unit_price", "created_at"
    ),
    "bronze_orders": _landing("order_id", "customer_id", "order_date", "shipping_address"),
    "bronze_order_items": _landing(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        "line_status",
        "status_updated_at",
    ),
    # Read by no query; landed so that nothing has to be fetched again.
    "bronze_shipments": _landing(
        "shipment_id",
        "order_id",
        "carrier",
        "tracking_number",
        "shipped_at",
        "estimated_delivery",
        "actual_delivery",
        "shipping_status",
    ),
}
# Text of a landed row that did not fit its header; NULL for whole rows.
CORRUPT = "_corrupt_record"

MONEY = T.DecimalType(10, 2)
LINE_MONEY = T.DecimalType(12, 2)
_key = lambda name: T.StructField(name, T.LongType(), nullable=False)

SILVER: dict[str, T.StructType] = {
    "silver_customers": T.StructType(
        [
            _key("customer_id"),
            T.StructField("first_name", T.StringType()),
            T.StructField("last_name", T.StringType()),
            T.StructField("email", T.StringType(), nullable=False),
            T.StructField("phone", T.StringType()),
            T.StructField("created_at", T.TimestampType()),
            T.StructField(UPDATED_TS, T.TimestampType()),
        ]
    ),
    "silver_products": T.StructType(
        [
            _key("product_id"),
            T.StructField("sku", T.StringType(), nullable=False),
            T.StructField("product_name", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("unit_price", MONEY),
            T.StructField("created_at", T.TimestampType()),
            T.StructField(UPDATED_TS, T.TimestampType()),
        ]
    ),
    "silver_orders": T.StructType(
        [
            _key("order_id"),
            _key("customer_id"),
            T.StructField("order_date", T.TimestampType()),
            T.StructField("shipping_address", T.StringType()),
            T.StructField(UPDATED_TS, T.TimestampType()),
        ]
    ),
    "silver_order_items": T.StructType(
        [
            _key("order_item_id"),
            _key("order_id"),
            _key("product_id"),
            T.StructField("quantity", T.IntegerType()),
            T.StructField("unit_price", MONEY),
            T.StructField("line_total", LINE_MONEY),
            T.StructField("line_status", T.StringType()),
            T.StructField("status_updated_at", T.TimestampType()),
            T.StructField(UPDATED_TS, T.TimestampType()),
        ]
    ),
}

# Surrogate key of each Silver table: what an upsert matches on unless told otherwise.
SILVER_KEYS: dict[str, list[str]] = {
    "silver_customers": ["customer_id"],
    "silver_products": ["product_id"],
    "silver_orders": ["order_id"],
    "silver_order_items": ["order_item_id"],
}

# Orders and their lines are stored by calendar month of the order, so that an upsert or a
# refresh rewrites the months it touches and no others. The column is part of the storage
# layout only; `contract` leaves it out.
MONTH = "order_month"
SILVER_LAYOUT: dict[str, str | None] = {
    "silver_customers": None,
    "silver_products": None,
    "silver_orders": MONTH,
    "silver_order_items": MONTH,
}


def declared_columns(table: str) -> list[Column]:
    """The columns of a Silver table in order, with their declared types."""
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER[table]]


def required(df: DataFrame, table: str) -> DataFrame:
    """`df` with a check on every NOT NULL column of its table: a NULL fails the write."""
    checks = {}
    for f in SILVER.get(table, ()):
        if not f.nullable and f.name in df.columns:
            message = F.lit(f"{table}.{f.name} must not be NULL")
            broken = F.raise_error(message).cast(f.dataType)
            checks[f.name] = F.when(F.col(f.name).isNull(), broken).otherwise(F.col(f.name))
    return df.withColumns(checks) if checks else df


def contract(df: DataFrame, table: str) -> DataFrame:
    """A Silver table as declared: without columns that only serve its storage."""
    return df.select(*declared_columns(table))
