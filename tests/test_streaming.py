from __future__ import annotations

import os
import subprocess
import sys
import uuid

import pytest

from strata.config import LayerConfig
from strata.session import checkpoint_root, scratch_path
from strata.sources import read_layer, read_raw_csv, seed_feed, write_raw_csv
from strata.streaming import ingest_bronze


def test_incremental_ingest_appends_each_file_once(spark):
    root = scratch_path(spark, "test-stream")
    feed = seed_feed(spark)
    cfg = LayerConfig(env="qa").with_prefix(f"ts_{uuid.uuid4().hex[:8]}")
    checkpoint = f"{root}/checkpoint"
    write_raw_csv(feed.filter("order_id < 'ORD-00200'"), f"{root}/landing/drop1")
    first = ingest_bronze(spark, cfg, "B1", f"{root}/landing/*", checkpoint, root)
    write_raw_csv(feed.filter("order_id >= 'ORD-00200'"), f"{root}/landing/drop2")
    second = ingest_bronze(spark, cfg, "B2", f"{root}/landing/*", checkpoint, root)
    third = ingest_bronze(spark, cfg, "B3", f"{root}/landing/*", checkpoint, root)
    assert (first["rows"], second["rows"], third["rows"]) == (200, 302, 0)
    bronze = read_layer(spark, cfg, "bronze", "orders_raw")
    assert bronze.count() == 502
    assert {r._batch_id: r["count"] for r in bronze.groupBy("_batch_id").count().collect()} == {"B1": 200, "B2": 302}
    # same rows as the batch contract scan of the whole landing folder
    batch = read_raw_csv(spark, f"{root}/landing/*")
    streamed = bronze.select(*batch.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_bounded_micro_batches_drain_the_backlog(spark):
    root = scratch_path(spark, "test-stream-batches")
    feed = seed_feed(spark).repartition(5)
    cfg = LayerConfig(env="qa").with_prefix(f"tb_{uuid.uuid4().hex[:8]}")
    write_raw_csv(feed, f"{root}/landing")
    out = ingest_bronze(spark, cfg, "B", f"{root}/landing", f"{root}/ckpt", root, max_files_per_trigger=2)
    assert out["rows"] == 502


def test_every_row_is_counted_over_many_batches(spark):
    # Spark keeps the progress of 100 batches; there are more here.
    root = scratch_path(spark, "test-stream-many")
    cfg = LayerConfig(env="qa").with_prefix(f"tm_{uuid.uuid4().hex[:8]}")
    write_raw_csv(seed_feed(spark).repartition(104), f"{root}/landing")
    out = ingest_bronze(spark, cfg, "B", f"{root}/landing", f"{root}/ckpt", root, max_files_per_trigger=1)
    assert out["rows"] == read_layer(spark, cfg, "bronze", "orders_raw").count() == 502


def test_another_application_goes_on_from_the_checkpoint(spark):
    """A second Spark application on the same table and checkpoint ingests what landed since."""
    root = scratch_path(spark, "test-stream-apps").removeprefix("file:")
    feed = seed_feed(spark)
    script = """
import sys
from strata.config import LayerConfig
from strata.session import local_session
from strata.streaming import ingest_bronze
root, run = sys.argv[1:]
spark = local_session(cores=2, shuffle_partitions=2)
spark.sql(f"CREATE DATABASE IF NOT EXISTS apps_bronze LOCATION '{root}/db'")
if spark.catalog.tableExists("apps_bronze.orders_raw") is False and run == "2":
    spark.catalog.createTable("apps_bronze.orders_raw", path=f"{root}/db/orders_raw", source="parquet")
out = ingest_bronze(spark, LayerConfig(env="qa").with_prefix("apps"), run, f"{root}/landing/*", f"{root}/ckpt", root)
print("ROWS", out["rows"], spark.table("apps_bronze.orders_raw").count())
"""
    seen = []
    for run, part in (("1", "order_id < 'ORD-00200'"), ("2", "order_id >= 'ORD-00200'")):
        write_raw_csv(feed.filter(part), f"{root}/landing/drop{run}")
        done = subprocess.run([sys.executable, "-c", script, root, run], capture_output=True, text=True, timeout=300, cwd=root, env=os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))})
        seen += [line.split()[1:] for line in done.stdout.splitlines() if line.startswith("ROWS")] or [done.stderr[-2000:]]
    assert seen == [["200", "200"], ["302", "502"]]


def test_scratch_needs_a_shared_folder_off_local_masters():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
