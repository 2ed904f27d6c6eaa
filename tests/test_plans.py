"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from __spark_entry__ import queries
from strata.plans.queries import QUERIES
from tests.conftest import SF_SMALL

# Queries with eager side effects (they write tables/files when built).
WRITES = {"csv_ingest", "layer_roundtrip", "medallion_e2e", "stream_ingest"}


def _explain(df, mode: str) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def _plan(df) -> str:
    return _explain(df, "simple")


def _formatted(df) -> str:
    return _explain(df, "formatted")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_python_in_plans(spark, name):
    plan = _formatted(queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan, f"{name} runs Python: {node}"


def test_dedup_limits_each_key_before_the_shuffle(spark):
    plan = _formatted(queries()["clean_orders"](spark, SF_SMALL))
    partial = plan.find("WindowGroupLimit")
    exchange = plan.find("Exchange", partial)
    assert "Partial" in plan and "Final" in plan
    assert 0 <= partial < exchange


def test_dedup_never_sorts_whole_scan_tasks(spark, tmp_path):
    from strata.operators import deduplicate_latest

    path = str(tmp_path / "rows")
    spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "key string, at int, v string").write.parquet(path)
    rows = deduplicate_latest(spark.read.parquet(path), ["key"], "at", tie_breakers=["v"])
    lines = _plan(rows).splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    # AQE sizes the partitions that the partial limit sorts.
    assert any("REBALANCE_PARTITIONS" in line for line in lines[partial:scan]), lines
    assert sorted(map(tuple, rows.collect())) == [("a", 2, "y"), ("b", 1, "z")]


def test_gold_scan_reads_only_needed_columns(spark):
    plan = _formatted(queries()["daily_country_sales"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem, plan
    cols = {c.split(":")[0] for c in lineitem[0].split(",")}
    assert cols == {"l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"}


def test_gold_aggregates_partially_before_shuffling(spark):
    plan = _formatted(queries()["daily_country_sales"](spark, SF_SMALL))
    assert plan.count("HashAggregate") >= 4  # partial + final for each of the two phases


def test_filters_reach_the_parquet_scan(spark):
    plan = _formatted(queries()["duplicate_keys"](spark, SF_SMALL))
    assert "Scan parquet" in plan and "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_text_jobs_do_not_shuffle_by_key(spark):
    # Only the conditional round-robin rebalance of an unsplittable scan may appear.
    for name in ("redact_text", "clip_text", "required_markers", "rule_scan", "extract_metrics"):
        plan = _formatted(queries()[name](spark, SF_SMALL))
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan, name


def test_scans_are_spread_only_on_request(spark):
    from strata.session import SPREAD_CONF
    from strata.sources.feeds import load, load_text

    assert "Exchange" not in _formatted(load(spark, SF_SMALL, "documents"))
    assert "RoundRobinPartitioning" in _formatted(load(spark, SF_SMALL, "documents", spread=True))
    chosen = spark.conf.get(SPREAD_CONF)
    try:
        spark.conf.unset(SPREAD_CONF)
        assert "Exchange" not in _formatted(load_text(spark, SF_SMALL, "documents"))
    finally:
        spark.conf.set(SPREAD_CONF, chosen)


def test_the_fact_is_never_broadcast(spark):
    plan = _plan(queries()["clean_orders"](spark, SF_SMALL))
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            # A dimension below the byte threshold, never what grows with the orders.
            scan = next(x for x in lines[i:] if "FileScan" in x)
            assert "lineitem.parquet" not in scan and "orders.parquet" not in scan
    assert sum("SortMergeJoin" in line for line in lines) == 2


@pytest.mark.parametrize("name", ["table_diff", "table_row_counts", "stage_metrics", "quality_profile", "quality_verdict"])
def test_the_feed_is_joined_once(spark, name):
    # The feed is written once before; what is left reads that table.
    assert "lineitem.parquet" not in _plan(queries()[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["table_row_counts", "stage_metrics"])
def test_orders_are_cleansed_once(spark, name):
    # The clean rows are written once before; what is left reads that table.
    assert "Window" not in _plan(queries()[name](spark, SF_SMALL))


def test_metric_lines_are_made_once_for_all_writes(spark, monkeypatch):
    from strata.plans import medallion

    plans, write = [], medallion.write_metrics
    monkeypatch.setattr(medallion, "write_metrics", lambda lines, *args: plans.append(_plan(lines)) or write(lines, *args))
    assert queries()["stage_metrics_table"](spark, SF_SMALL).count() == 4
    assert len(plans) == 3 and not any("Exchange" in p or "Aggregate" in p for p in plans)


def test_amounts_are_not_shuffled_to_find_the_latest(spark, feed):
    from strata.operators import clean_orders
    from tests.conftest import order

    rows = feed(order("k1"), order("k1", price=3.0), order("k2"))
    plan = _plan(clean_orders(rows))
    last = plan.index("Exchange")  # the plan is printed from its end
    assert "gross_amount" in plan[:last] and "gross_amount" not in plan[last:]
    # Derived columns that break ties must be there before: the smaller amount stays.
    kept = clean_orders(rows, tie_breakers=["gross_amount", "Order_Date"]).orderBy("order_id")
    assert kept.columns == clean_orders(rows).columns
    assert [(r.order_id, r.gross_amount) for r in kept.collect()] == [("k1", 9.0), ("k2", 9.0)]


def _left_shuffle_files(spark, write, kept=False):
    """Shuffle files that ``write`` leaves; waits for those that another thread deletes, unless some are to be kept."""
    import time

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {b for b in disk.getAllBlocks().mkString("\n").split("\n") if b.startswith("shuffle_")}

    held = files()
    write()
    for _ in range(1 if kept else 100):
        if not (left := files() - held):
            break
        time.sleep(0.1)
    return left


def test_released_shuffles_leave_no_files_and_the_option_as_it_was(spark, tmp_path):
    from strata.session import _CLEANUP_CONF, released_shuffles

    def write(name):
        spark.range(1000).hint("rebalance", "id").write.parquet(str(tmp_path / name))

    def released(name):
        with released_shuffles(spark):
            write(name)

    assert _left_shuffle_files(spark, lambda: write("plain"), kept=True)
    try:
        for before in (None, "false"):
            if before:
                spark.conf.set(_CLEANUP_CONF, before)
            assert not _left_shuffle_files(spark, lambda name=str(before): released(name))
            assert spark.conf.get(_CLEANUP_CONF, None) == before
    finally:
        spark.conf.unset(_CLEANUP_CONF)


def test_layer_and_landing_writes_leave_no_shuffle_files(spark, tmp_path):
    import uuid

    from strata.config import LayerConfig
    from strata.session import scratch_path
    from strata.sources import ensure_schemas, write_raw_csv
    from strata.sources.versions import stage_version

    cfg = LayerConfig(env="qa").with_prefix(f"sh_{uuid.uuid4().hex[:8]}")
    ensure_schemas(spark, cfg, scratch_path(spark, "test-shuffles"))
    rows = spark.range(1000).selectExpr("id", "id % 3 AS part").hint("rebalance", "id")
    assert not _left_shuffle_files(spark, lambda: stage_version(rows, cfg, "silver", "t", partition_by=["part"]))
    assert not _left_shuffle_files(spark, lambda: write_raw_csv(rows, str(tmp_path / "landing")))


def test_partitioned_silver_write_reads_rows_that_are_stored(spark, monkeypatch):
    import uuid

    from strata.config import LayerConfig
    from strata.plans import medallion as M
    from strata.session import scratch_path
    from strata.sources import read_layer, seed_feed, write_raw_csv
    from strata.sources.versions import layer_versions, stage_version

    root = scratch_path(spark, "test-kept")
    cfg = LayerConfig(env="qa").with_prefix(f"kp_{uuid.uuid4().hex[:8]}")
    M.run_bronze(spark, cfg, "B", write_raw_csv(seed_feed(spark), f"{root}/landing"), root)
    stage_version(spark.range(3), cfg, "silver", M.KEPT_TABLE)  # as a lost job leaves it
    plans = {}

    def staged(df, cfg, layer, name, partition_by=None, measures=None):
        plans[bool(partition_by)] = _plan(df)
        return stage_version(df, cfg, layer, name, partition_by, measures)

    monkeypatch.setattr(M, "stage_version", staged)
    M.run_silver(spark, cfg, "B")
    # The cleansing shuffles are over, and gone, when the partitioned write begins to shuffle.
    assert "Window" in plans[False] and "Exchange" not in plans[True]
    assert read_layer(spark, cfg, "silver", M.SILVER_TABLE).count() == 500
    assert layer_versions(spark, cfg, "silver", M.KEPT_TABLE) == []

    def broken(df, cfg, layer, name, partition_by=None, measures=None):
        if partition_by:
            raise RuntimeError("disk lost")
        return stage_version(df, cfg, layer, name, partition_by, measures)

    monkeypatch.setattr(M, "stage_version", broken)
    with pytest.raises(RuntimeError, match="disk lost"):
        M.run_silver(spark, cfg, "B")
    assert layer_versions(spark, cfg, "silver", M.KEPT_TABLE) == []
    assert read_layer(spark, cfg, "silver", M.SILVER_TABLE).count() == 500


def test_compressed_landing_holds_the_same_rows_in_bounded_files(spark, tmp_path, monkeypatch):
    import glob

    from strata.sources import files, read_raw_csv, seed_feed

    feed = seed_feed(spark).coalesce(1)
    monkeypatch.setattr(files, "ROWS_PER_COMPRESSED_FILE", 100)
    packed = files.write_raw_csv(feed, str(tmp_path / "packed"), compression="gzip")
    plain = files.write_raw_csv(feed, str(tmp_path / "plain"))
    assert len(glob.glob(f"{packed}/*.csv.gz")) == 6 and len(glob.glob(f"{plain}/*.csv")) == 1
    back = [sorted(map(tuple, read_raw_csv(spark, path).collect()), key=str) for path in (packed, plain)]
    assert back[0] == back[1] and len(back[0]) == 502


def test_log_lines_are_read_once(spark):
    assert _plan(queries()["metrics_report"](spark, SF_SMALL)).count("events.parquet") == 1


def test_metric_payloads_are_parsed_once(spark):
    df = queries()["extract_metrics"](spark, SF_SMALL)
    assert _plan(df).count("from_json(") == 1


def test_silver_reads_prune_order_date_partitions(spark):
    import uuid
    from datetime import date

    from pyspark.sql import functions as F

    from strata.config import LayerConfig
    from strata.session import scratch_path
    from strata.sources import ensure_schemas, read_layer, write_layer

    cfg = LayerConfig(env="qa").with_prefix(f"pp_{uuid.uuid4().hex[:8]}")
    ensure_schemas(spark, cfg, scratch_path(spark, "test-prune"))
    df = spark.createDataFrame([("a", date(2026, 1, 1)), ("b", date(2026, 1, 2))], "order_id string, order_date date")
    write_layer(df, cfg, "silver", "orders_clean", partition_by=["order_date"])
    one_day = read_layer(spark, cfg, "silver", "orders_clean").filter(F.col("order_date") == F.lit(date(2026, 1, 2)))
    plan = _formatted(one_day)
    assert re.search(r"PartitionFilters: \[.*order_date", plan), plan
    assert [r.order_id for r in one_day.collect()] == ["b"]


def test_validity_predicates_reach_a_bronze_scan(spark, tmp_path):
    from datetime import datetime

    from strata.operators import clean_orders
    from strata.schemas import RAW_ORDERS

    path = str(tmp_path / "bronze")
    spark.createDataFrame([("O", "C", "P", "IN", 1, 1.0, datetime(2026, 1, 1))], RAW_ORDERS).write.parquet(path)
    plan = _formatted(clean_orders(spark.read.parquet(path)))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThan(quantity,0)" in pushed and "GreaterThan(unit_price,0.0)" in pushed
