"""Incremental bronze ingest of the landing folder with Structured Streaming.

The batch bronze step re-reads every file in the landing folder on each run.
This is the same scan (contract schema, PERMISSIVE CSV, audit columns) as a
file stream with an ``availableNow`` trigger: each run appends only the
files that landed since the previous run. The checkpoint records which files
are done, so a file is ingested exactly once even when a run or an executor
fails halfway. Its folder is the caller's to name: it must be the same one,
on shared storage, for every run that feeds a table.

Differences from the full-overwrite batch step, by design: ``_batch_id``
is the id of the run that ingested a row, and rows of a landing file that
is later deleted stay in bronze.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.config import LayerConfig
from strata.operators.cleanse import add_audit_columns
from strata.schemas import RAW_ORDERS
from strata.sources.tables import ensure_schemas

BRONZE_TABLE = "orders_raw"


def landing_stream(spark: SparkSession, source_path: str, max_files_per_trigger: int | None = None):
    """The landing folder as a streaming DataFrame under the contract schema."""
    reader = spark.readStream.option("header", "true").option("mode", "PERMISSIVE").schema(RAW_ORDERS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(source_path)


def start_bronze_ingest(
    spark: SparkSession,
    cfg: LayerConfig,
    batch_id: str,
    source_path: str,
    checkpoint: str,
    location_root: str | None = None,
    table: str = BRONZE_TABLE,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append the not-yet-ingested landing files to the bronze table, then stop.

    ``max_files_per_trigger`` bounds each micro-batch; ``availableNow`` still
    drains the whole backlog, in as many batches as needed. Returns the
    started query; ``ingest_bronze`` waits for it.
    """
    ensure_schemas(spark, cfg, location_root)
    fqn = cfg.table("bronze", table)
    bronze = add_audit_columns(landing_stream(spark, source_path, max_files_per_trigger), batch_id)
    return (
        bronze.writeStream.format(cfg.table_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(fqn)
    )


def ingest_bronze(
    spark: SparkSession,
    cfg: LayerConfig,
    batch_id: str,
    source_path: str,
    checkpoint: str,
    location_root: str | None = None,
    table: str = BRONZE_TABLE,
    max_files_per_trigger: int | None = None,
) -> dict:
    """Run one incremental ingest to completion; returns the table and the rows appended.

    The rows are those that the table has gained (progress reports are kept
    for the last batches only); so only one ingest may run on a table at a time.
    """
    fqn = cfg.table("bronze", table)
    before = spark.table(fqn).count() if spark.catalog.tableExists(fqn) else 0
    query = start_bronze_ingest(
        spark, cfg, batch_id, source_path, checkpoint, location_root, table, max_files_per_trigger
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    after = spark.table(fqn).count() if spark.catalog.tableExists(fqn) else 0
    return {"table": fqn, "rows": after - before}
