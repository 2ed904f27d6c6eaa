"""Synthetic landing feed for bootstrapping an environment.

Generated on the executors from ``spark.range``: each field is a hash of the
row id, so the feed is deterministic for a given ``seed`` and any size. It
keeps the shape of the bootstrap feed (value ranges, hourly timestamps and
two dirty rows); it does not replay any particular random sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import RAW_ORDERS

# The bootstrap feed's domains.
COUNTRIES = ("IN", "US", "UK", "DE", "AU")
CUSTOMERS = 120
PRODUCTS = 60
MAX_QUANTITY = 8
PRICE_LOW_CENTS = 450
PRICE_HIGH_CENTS = 25_000
START = "2026-01-01 00:00:00"
BAD_ORDER_ID = "ORD-BAD-1"


def _draw(salt: int, seed: int, modulus: int) -> Column:
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(salt)), F.lit(modulus))


def seed_feed(spark: SparkSession, rows: int = 500, seed: int = 42) -> DataFrame:
    """``rows`` orders plus an exact copy of the first and one invalid order.

    The invalid one copies order 2 with id ``ORD-BAD-1``, an empty customer,
    quantity 0 and price 0.0, so ``rows`` orders survive cleansing.
    """
    countries = F.array(*[F.lit(c) for c in COUNTRIES])
    base = spark.range(1, rows + 1).select(
        F.col("id"),
        F.format_string("ORD-%05d", F.col("id")).alias("order_id"),
        F.format_string("CUST-%04d", _draw(1, seed, CUSTOMERS) + 1).alias("customer_id"),
        F.format_string("SKU-%03d", _draw(2, seed, PRODUCTS) + 1).alias("product_id"),
        F.element_at(countries, (_draw(3, seed, len(COUNTRIES)) + 1).cast("int")).alias("country"),
        (_draw(4, seed, MAX_QUANTITY) + 1).cast("int").alias("quantity"),
        ((_draw(5, seed, PRICE_HIGH_CENTS - PRICE_LOW_CENTS + 1) + PRICE_LOW_CENTS) / F.lit(100.0)).alias(
            "unit_price"
        ),
        F.expr(f"TIMESTAMP '{START}' + make_dt_interval(0, CAST(id AS INT), 0, 0)")
        .cast("timestamp")
        .alias("order_ts"),
    )
    duplicate = base.filter(F.col("id") == 1)
    invalid = base.filter(F.col("id") == 2).withColumns(
        {
            "order_id": F.lit(BAD_ORDER_ID),
            "customer_id": F.lit(""),
            "quantity": F.lit(0),
            "unit_price": F.lit(0.0),
        }
    )
    feed = base.unionByName(duplicate).unionByName(invalid)
    return feed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_ORDERS.fields])
