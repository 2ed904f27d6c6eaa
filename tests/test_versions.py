"""Write, audit, publish: what a lost or failed run leaves behind."""

from __future__ import annotations

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.config import preset
from strata.operators.quality import QualityGateError
from strata.plans import medallion as M
from strata.schemas import RAW_ORDERS
from strata.session import scratch_path
from strata.sources import ensure_schemas, read_layer, seed_feed, write_layer, write_raw_csv
from strata.sources import versions as V
from tests.conftest import order


@pytest.fixture()
def layers(spark):
    root = scratch_path(spark, "test-versions")
    cfg = preset("prod", catalog=None).with_prefix(f"v_{uuid.uuid4().hex[:8]}")
    ensure_schemas(spark, cfg, root)
    return cfg, root


def _land(spark, root, df):
    return write_raw_csv(df, f"{root}/landing-{uuid.uuid4().hex[:6]}")


def _rows(spark, cfg):
    return sorted(map(tuple, read_layer(spark, cfg, "silver", M.SILVER_TABLE).collect()), key=str)


def _second_feed(spark):
    return seed_feed(spark).withColumn("quantity", F.col("quantity") + 1)


def test_job_lost_between_write_and_publish_leaves_silver_whole(spark, layers, monkeypatch):
    cfg, root = layers
    M.run_bronze(spark, cfg, "B-1", _land(spark, root, seed_feed(spark)), root)
    M.run_silver(spark, cfg, "B-1")
    before, held = _rows(spark, cfg), V.layer_versions(spark, cfg, "silver", M.SILVER_TABLE)
    assert len(before) == 500 and len(held) == 1
    running = read_layer(spark, cfg, "silver", M.SILVER_TABLE)

    class Killed(BaseException):
        """Not an error that the step could clean up after."""

    def killed(*_):
        raise Killed

    M.run_bronze(spark, cfg, "B-2", _land(spark, root, _second_feed(spark)), root)
    monkeypatch.setattr(M, "publish_version", killed)
    with pytest.raises(Killed):
        M.run_silver(spark, cfg, "B-2")
    monkeypatch.undo()
    left = V.layer_versions(spark, cfg, "silver", M.SILVER_TABLE)
    assert len(left) == 2 and spark.read.table(left[1]).count() == 500  # written whole, and unseen
    assert _rows(spark, cfg) == before

    M.run_silver(spark, cfg, "B-2")
    after = _rows(spark, cfg)
    assert len(after) == 500 and after != before
    M.run_silver(spark, cfg, "B-3")
    assert left[1] not in V.layer_versions(spark, cfg, "silver", M.SILVER_TABLE)  # what the lost job left is gone
    assert len(V.layer_versions(spark, cfg, "silver", M.SILVER_TABLE)) == 2
    assert running.columns == read_layer(spark, cfg, "silver", M.SILVER_TABLE).columns


def test_reader_that_began_before_a_publication_ends_with_its_version(spark, layers):
    cfg, _ = layers
    write_layer(spark.range(100), cfg, "silver", "t")
    running = read_layer(spark, cfg, "silver", "t")
    write_layer(spark.range(100, 130), cfg, "silver", "t")
    assert (running.agg(F.max("id")).first()[0], running.count()) == (99, 100)
    assert read_layer(spark, cfg, "silver", "t").count() == 30


def test_write_that_fails_midway_leaves_the_table(spark, layers):
    cfg, _ = layers
    write_layer(spark.range(50), cfg, "gold", "t")
    broken = spark.range(0, 1000, 1, 8).withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("disk lost")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="disk lost"):
        write_layer(broken, cfg, "gold", "t")
    assert read_layer(spark, cfg, "gold", "t").count() == 50
    write_layer(spark.range(7), cfg, "gold", "t")
    assert read_layer(spark, cfg, "gold", "t").count() == 7


def test_strict_gate_audits_the_files_and_discards_them(spark, layers, feed):
    cfg, root = layers
    M.run_bronze(spark, cfg, "B", _land(spark, root, seed_feed(spark)), root)
    M.run_silver(spark, cfg, "B")
    before = _rows(spark, cfg)
    M.run_bronze(spark, cfg, "B", _land(spark, root, feed(order("a"), order("b", customer=""))), root)
    with pytest.raises(QualityGateError, match="rejection rate 50.00%"):
        M.run_silver(spark, cfg, "B")
    assert _rows(spark, cfg) == before and len(V.layer_versions(spark, cfg, "silver", M.SILVER_TABLE)) == 1


def test_files_that_lack_rows_are_not_published(spark, layers):
    cfg, _ = layers
    staged = V.stage_version(spark.range(10), cfg, "silver", "t", measures={"most": F.max("id")})
    assert (staged.rows, staged.measures["most"]) == (10, 9)
    V.check_version(staged, 10)
    with pytest.raises(V.IncompleteVersionError, match="wrote 10 rows, its files hold 9"):
        V.check_version(staged, 9)
    assert not spark.catalog.tableExists(cfg.table("silver", "t"))
    V.discard_version(spark, staged)
    assert V.layer_versions(spark, cfg, "silver", "t") == []


def test_schema_and_partitions_may_change_with_a_version(spark, layers):
    cfg, _ = layers
    write_layer(spark.range(5), cfg, "silver", "t")
    days = spark.createDataFrame([(1, datetime(2030, 1, 1).date()), (2, None)], "k int, day date")
    write_layer(days, cfg, "silver", "t", partition_by=["day"])
    assert sorted(map(tuple, read_layer(spark, cfg, "silver", "t").select("k", "day").collect()), key=str) == sorted(map(tuple, days.collect()), key=str)
    write_layer(spark.createDataFrame([], RAW_ORDERS), cfg, "silver", "t")
    empty = read_layer(spark, cfg, "silver", "t")
    assert empty.columns == RAW_ORDERS.fieldNames() and empty.count() == 0


def test_plain_table_of_the_name_becomes_a_version(spark, layers):
    cfg, _ = layers
    spark.range(3).write.saveAsTable(cfg.table("gold", "t"))
    write_layer(spark.range(4), cfg, "gold", "t")
    assert read_layer(spark, cfg, "gold", "t").count() == 4
    assert V.layer_versions(spark, cfg, "gold", "t")[0] == cfg.table("gold", "t__v0")
    write_layer(spark.range(5), cfg, "gold", "t")
    assert cfg.table("gold", "t__v0") not in V.layer_versions(spark, cfg, "gold", "t")


def test_versions_of_one_name_are_not_those_of_another(spark, layers):
    cfg, _ = layers
    for name in ("t", "t2", "a_t"):
        write_layer(spark.range(1), cfg, "gold", name)
    assert len(V.layer_versions(spark, cfg, "gold", "t")) == 1


def test_schema_locations_are_quoted(spark):
    cfg = preset("qa", catalog=None).with_prefix(f"q_{uuid.uuid4().hex[:8]}")
    root = scratch_path(spark, "it's")
    ensure_schemas(spark, cfg, root)
    write_layer(spark.range(2), cfg, "gold", "t")
    assert read_layer(spark, cfg, "gold", "t").count() == 2
    assert "it's" in spark.catalog.getDatabase(cfg.gold_schema).locationUri
