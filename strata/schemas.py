"""Explicit schemas of the order feed and its layers (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Every field is nullable: the CSV scan is PERMISSIVE, and rejecting incomplete
# records is the silver layer's job, not the reader's.
RAW_ORDERS = StructType(
    [
        StructField("order_id", StringType(), True),
        StructField("customer_id", StringType(), True),
        StructField("product_id", StringType(), True),
        StructField("country", StringType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("unit_price", DoubleType(), True),
        StructField("order_ts", TimestampType(), True),
    ]
)
RAW_COLUMNS = tuple(f.name for f in RAW_ORDERS.fields)

AUDIT_COLUMNS = ("_ingested_at", "_source_file", "_batch_id")

DERIVED_COLUMNS = ("gross_amount", "order_date")

# Column order of the gold mart.
GOLD_COLUMNS = (
    "order_date",
    "country",
    "order_count",
    "customer_count",
    "gross_revenue",
    "avg_order_value",
)

GOLD_INPUT = StructType(
    [
        StructField("order_id", StringType(), True),
        StructField("customer_id", StringType(), True),
        StructField("country", StringType(), True),
        StructField("order_date", DateType(), True),
        StructField("gross_amount", DoubleType(), True),
    ]
)

QUALITY_REPORT = StructType(
    [
        StructField("input_rows", LongType(), False),
        StructField("output_rows", LongType(), False),
        StructField("null_key_rows", LongType(), False),
        StructField("duplicate_key_rows", LongType(), False),
    ]
)
