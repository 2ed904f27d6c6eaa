"""Run the key-sensitive operators on data where one key holds a third of the rows.

    python tests/skew_probe.py <scratch_dir>

Prints one JSON object: for each operator, the hot-key row count and the
largest number of shuffled records any single task read. Run in its own
process (own session, event log in the scratch folder); used by
tests/test_skew.py. AQE's skew thresholds are lowered so that its join-skew
handling engages at this small size, as it would at scale, and partition
coalescing is off so that one task reads exactly one hash partition.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

ROWS = 600_000
HOT = ROWS // 3


def main(scratch: str) -> None:
    os.makedirs(f"{scratch}/events", exist_ok=True)
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("strata-skew-probe")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"{scratch}/events")
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256k")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        # One reducer task per hash partition, so a task's input shows where keys landed.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from strata.config import LayerConfig
    from strata.operators import daily_country_sales, deduplicate_latest
    from strata.operators import quality as Q
    from strata.sources.feeds import orders_feed
    from strata.sources.tables import ensure_schemas, write_layer

    hot = F.col("id") % 3 == 0
    orders = spark.range(0, ROWS, 1, 16).select(
        F.when(hot, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("order_id"),
        F.when(hot, F.lit("C-HOT")).otherwise((F.col("id") % 5000).cast("string")).alias("customer_id"),
        F.when(hot, F.lit("IN")).otherwise((F.col("id") % 25).cast("string")).alias("country"),
        F.when(hot, F.lit("2026-01-01")).otherwise(F.date_add(F.lit("2026-01-01"), (F.col("id") % 90).cast("int"))).cast("date").alias("order_date"),
        ((F.col("id") % 1000) / 100.0).alias("gross_amount"),
        F.timestamp_seconds(F.col("id")).alias("order_ts"),
    )

    # A star schema whose fact table has one l_orderkey holding a third of the rows.
    sf = f"{scratch}/star"
    li = spark.range(0, ROWS, 1, 16).select(
        F.when(hot, F.lit(1)).otherwise(F.col("id")).cast("bigint").alias("l_orderkey"),
        (F.col("id") % 1000).cast("bigint").alias("l_partkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        ((F.col("id") % 100000) / 100.0).alias("l_extendedprice"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("l_shipdate"),
    )
    li.write.mode("overwrite").parquet(f"{sf}/lineitem.parquet")
    spark.range(0, ROWS).select(F.col("id").alias("o_orderkey"), (F.col("id") % 1000).alias("o_custkey")).write.mode(
        "overwrite"
    ).parquet(f"{sf}/orders.parquet")
    spark.range(0, 1000).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")).write.mode(
        "overwrite"
    ).parquet(f"{sf}/customer.parquet")
    spark.range(0, 25).select(F.col("id").cast("int").alias("n_nationkey"), F.concat(F.lit("N"), F.col("id")).alias("n_name")).write.mode(
        "overwrite"
    ).parquet(f"{sf}/nation.parquet")

    runs = {
        "dedupe_latest": lambda: deduplicate_latest(orders, ["order_id"], "order_ts"),
        "daily_country_sales": lambda: daily_country_sales(orders),
        "quality_profile": lambda: Q.profile(orders, orders),
        "duplicate_keys": lambda: Q.duplicate_keys(orders, ["order_id"]),
        "multiset_difference": lambda: Q.multiset_difference(orders.select("order_id"), orders.select("order_id").limit(10)),
        "fact_join": lambda: orders_feed(spark, sf),
    }
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()

    # The partitioned layer write, with one order_date holding a third of the rows.
    cfg = LayerConfig(env="qa").with_prefix("skewprobe")
    ensure_schemas(spark, cfg, f"{scratch}/layers")
    spark.sparkContext.setJobGroup("partitioned_write", "partitioned_write")
    write_layer(orders, cfg, "silver", "orders_clean", partition_by=["order_date"])
    runs["partitioned_write"] = None
    spark.stop()

    groups, stage_group, task_max = {}, {}, {}
    for path in glob.glob(f"{scratch}/events/*"):
        files = glob.glob(f"{path}/events_*") if os.path.isdir(path) else [path]
        for f in files:
            with open(f, "rb") as fh:
                raw = fh.read()
            if f.endswith(".zstd"):
                raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
            for line in raw.decode("utf-8").splitlines():
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    g = e["Properties"].get("spark.jobGroup.id")
                    for st in e["Stage Infos"]:
                        stage_group[st["Stage ID"]] = g
                elif e["Event"] == "SparkListenerTaskEnd":
                    read = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    g = stage_group.get(e["Stage ID"])
                    if g:
                        task_max[g] = max(task_max.get(g, 0), read)
    for name in runs:
        groups[name] = {"hot_rows": HOT, "max_task_shuffle_records": task_max.get(name, 0)}
    print(json.dumps(groups))


if __name__ == "__main__":
    main(sys.argv[1])
