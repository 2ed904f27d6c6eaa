"""Feeds shaped from the driver's star-schema tables.

``orders_feed`` turns ``lineitem``/``orders``/``customer``/``nation`` into the
raw order-feed shape (with deterministic dirty rows, keyed on ``l_partkey``),
and ``log_lines`` turns ``events`` into log text carrying metric lines. Both
grow linearly with their input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import SPREAD_CONF


def load(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """One driver table, ``<sf_dir>/<name>.parquet``.

    ``spread=True`` rebalances the rows right after the scan (a shuffle):
    the caller's choice for a table of a few unsplittable files with heavy
    per-row work.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.hint("rebalance") if spread else df


def load_text(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with heavy per-row text work, rebalanced if the session's ``SPREAD_CONF`` says so."""
    return load(spark, sf_dir, name, spread=spark.conf.get(SPREAD_CONF, "false") == "true")


def _every(column: Column, n: int) -> Column:
    return (column % F.lit(n)) == F.lit(0)


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw order feed (contract columns) over ``lineitem`` with injected dirt.

    Join order keeps the fact table to a single shuffle: the narrow
    ``customer -> nation`` and ``orders -> customer`` dimension chain is built
    first, then joined once to ``lineitem`` on ``l_orderkey``.
    """
    lineitem = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    customer_nation = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner").select(
        "c_custkey", "n_name"
    )
    # Both joins below have two sides that grow with the data, so they are
    # shuffle joins at any scale: "merge" keeps the planner from broadcasting
    # a side whose filtered scan merely looks small. Nation is left to the
    # planner, which broadcasts it below its byte threshold. AQE splits
    # skewed keys.
    order_dim = orders.join(
        customer_nation.hint("merge"), orders.o_custkey == customer_nation.c_custkey, "inner"
    ).select("o_orderkey", "o_custkey", "n_name")
    joined = lineitem.join(order_dim.hint("merge"), lineitem.l_orderkey == order_dim.o_orderkey, "inner")

    part = F.col("l_partkey")
    # The dirt pattern of the feed (moduli of l_partkey).
    order_id = (
        F.when(_every(part, 101), F.lit(None).cast("string"))
        .when(_every(part, 103), F.lit("   "))
        .otherwise(
            F.concat(
                F.lit(" ORD-"),
                F.col("l_orderkey").cast("string"),
                F.lit("-"),
                F.col("l_linenumber").cast("string"),
            )
        )
    )
    customer_id = F.when(_every(part, 97), F.lit("   ")).otherwise(
        F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string"), F.lit(" "))
    )
    product_id = F.concat(F.lit(" SKU-"), part.cast("string"))
    country = F.when(
        _every(F.col("l_linenumber"), 3), F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))
    ).otherwise(F.col("n_name"))
    quantity = (
        F.when(_every(part, 89), F.lit(0))
        .when(_every(part, 107), F.lit(None).cast("int"))
        .otherwise(F.col("l_quantity").cast("int"))
    )
    unit_price = F.when(_every(part, 83), F.lit(0.0)).otherwise(F.col("l_extendedprice"))
    order_ts = F.when(_every(part, 109), F.lit(None).cast(joined.schema["l_shipdate"].dataType)).otherwise(
        F.col("l_shipdate")
    )
    return joined.select(
        order_id.alias("order_id"),
        customer_id.alias("customer_id"),
        product_id.alias("product_id"),
        country.alias("country"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        order_ts.alias("order_ts"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job-log lines over ``events``: ``(line_id, line)``.

    Most lines carry an ``ETL_METRICS {json}`` payload; every 7th event is a
    plain text line and every 11th a marker with a malformed payload.
    """
    events = load_text(spark, sf_dir, "events").select("event_id", "event_type", "props")
    event_id = F.col("event_id")
    # The shape of the log lines.
    line = (
        F.when(_every(event_id, 7), F.concat(F.lit("starting task "), F.col("event_type")))
        .when(_every(event_id, 11), F.lit("ETL_METRICS not-json"))
        .otherwise(
            F.concat(
                F.lit('[INFO] ETL_METRICS {"stage": "'),
                F.col("event_type"),
                F.lit('", "event_id": '),
                event_id.cast("string"),
                F.lit(', "input": '),
                F.col("props"),
                F.lit("}"),
            )
        )
    )
    return events.select(event_id.alias("line_id"), line.alias("line"))


def workflow_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workflow-shaped texts over ``documents``: ``(doc_id, text)``.

    Every document becomes the body of a small workflow file whose lines hit
    and miss each credential pattern, line rule and required marker in turn.
    """
    docs = load_text(spark, sf_dir, "documents").select("doc_id", "text")
    key, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    digits = F.lpad(key.cast("string"), 6, "0")
    hex_id = F.md5(key.cast("string"))

    def one_of(modulus: int, *lines) -> Column:
        chosen = F.lit("")
        for k, line in enumerate(lines):
            chosen = F.when(key % F.lit(modulus) == F.lit(k), line if isinstance(line, Column) else F.lit(line)).otherwise(chosen)
        return chosen

    # The shape of the workflow texts.
    parts = [
        one_of(7, "on: push\n", "\"on\":\n  push:\n", "true: push\n", "# on: push\n", "once: push\n", "'on': [push]\n"),
        one_of(5, "permissions: read-all\n", "\"permissions\":\n  contents: read\n", "  permissions: x\n", "permission: x\n"),
        one_of(
            11,
            "jobs:\n  a:\n    steps: x\n",
            "jobs: {}\n",
            "jobs:\n",
            "'jobs': {a: b}\n",
            "jobs: null # none\n",
            "jobs:\n- a\n",
            "jobs: x\n",
        ),
        one_of(
            13,
            F.concat(F.lit("run: dapi"), hex_id, F.lit("\n")),
            F.concat(F.lit("run: dapi"), F.substring(hex_id, 1, 20), F.lit("\n")),
            F.concat(F.lit("run: GHP_"), hex_id, F.lit("\n")),
            F.concat(F.lit("run: gho_"), digits, F.lit("\n")),
            F.concat(F.lit("run: sk-"), hex_id, F.lit("_\n")),
            F.concat(F.lit("run: sk-"), digits, F.lit("\n")),
            F.concat(F.lit("run: Password = "), hex_id, F.lit("\n")),
        ),
        one_of(
            6,
            F.concat(F.lit("  token: "), hex_id, F.lit("\n")),
            "  token: ${{ secrets.TOKEN }}\n",
            F.concat(F.lit("  client_secret: '"), hex_id, F.lit("'\n")),
            "  api-key: short\n",
        ),
        one_of(
            4,
            F.concat(F.lit("  uses: org/action"), digits, F.lit("@main\n")),
            F.concat(F.lit("  uses: org/action@v"), digits, F.lit("\n")),
            "  uses: org/action@master  \n",
        ),
    ]
    return docs.select(key, F.concat(*parts, text).alias("text"))
