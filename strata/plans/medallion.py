"""The bronze, silver and gold steps and their metrics lines.

* bronze: contract CSV scan of the landing folder + audit columns -> table.
* silver: bronze table -> ``clean_orders`` -> written as they come -> staged
  version partitioned by ``order_date`` -> quality gate on its files ->
  published. A strict failure, or a job lost on the way, leaves the silver
  table as it was.
* gold: silver table -> ``daily_country_sales`` -> table.

Each step ends with one ``ETL_METRICS {json}`` line. Row counts of written
versions come from an ``Observation`` on the write itself instead of a second
job over the data.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import LayerConfig
from strata.operators.cleanse import add_audit_columns, clean_orders
from strata.operators.marts import daily_country_sales
from strata.operators.quality import apply_gate, profile, verdict
from strata.sources.files import read_raw_csv
from strata.sources.tables import ensure_schemas, read_layer
from strata.sources.versions import check_version, discard_version, discard_versions, publish_version, quoted, stage_version

# Table names, the metrics marker, and the fields of each line below.
BRONZE_TABLE = "orders_raw"
SILVER_TABLE = "orders_clean"
KEPT_TABLE = "orders_kept"
GOLD_TABLE = "daily_country_sales"
METRICS_MARKER = "ETL_METRICS "


def default_batch_id(now: datetime | None = None) -> str:
    """UTC timestamp ``YYYYMMDDTHHMMSSZ`` (16 characters)."""
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def metrics_line(stage: str, payload: dict) -> str:
    """``ETL_METRICS {"stage": ..., **payload}``; values JSON can't hold become strings."""
    return f"{METRICS_MARKER}{json.dumps({'stage': stage, **payload}, default=str)}"


@dataclass
class StepResult:
    table: str
    metrics: dict = field(default_factory=dict)

    @property
    def line(self) -> str:
        return metrics_line(self.metrics.get("stage", ""), {k: v for k, v in self.metrics.items() if k != "stage"})


def metric_record(stage: str, payload: list):
    """``struct(stage, line)``: the ``ETL_METRICS {json}`` line as a column (compact JSON).

    ``payload`` holds aliased columns in output order.
    """
    # A missing value is written as null, as json.dumps writes it.
    record = F.to_json(F.struct(F.lit(stage).alias("stage"), *payload), {"ignoreNullFields": "false"})
    return F.struct(F.lit(stage).alias("stage"), F.concat(F.lit(METRICS_MARKER), record).alias("line"))


def metrics_frame(one_row: DataFrame, stage: str, payload: list) -> DataFrame:
    """``(stage, line)`` built on the executors from a one-row aggregate."""
    return one_row.select(metric_record(stage, payload).alias("m")).select("m.*")


def _emit(stage: str, payload: dict, log: Callable[[str], None]) -> dict:
    log(metrics_line(stage, payload))
    return {"stage": stage, **payload}


def metrics_sink(spark: SparkSession, table: str, log: Callable[[str], None] = print) -> Callable[[str], None]:
    """A ``log`` for the steps that also keeps each metrics line in ``table`` (see ``write_metrics``)."""

    def write(line: str) -> None:
        log(line)
        if line.startswith(METRICS_MARKER):
            payload = json.loads(line.removeprefix(METRICS_MARKER))
            write_metrics(spark.createDataFrame([(payload["stage"], line)], "stage string, line string"), table, str(payload.get("batch_id", "")))

    return write


def write_metrics(lines: DataFrame, table: str, batch_id: str) -> str:
    """Keep the ``(stage, line)`` rows of a batch in ``table``, one partition for each batch and stage.

    Idempotent: a batch that runs again replaces its own lines, and only
    those of the stages that it brings, in one dynamic overwrite.
    """
    spark = lines.sparkSession
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} (line STRING, batch_id STRING, stage STRING) USING parquet "
        "OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (batch_id, stage)"
    )
    lines.select("line", F.lit(batch_id).alias("batch_id"), "stage").write.insertInto(table, overwrite=True)
    return table


def run_bronze(
    spark: SparkSession,
    cfg: LayerConfig,
    batch_id: str,
    source_path: str | None = None,
    location_root: str | None = None,
    log: Callable[[str], None] = print,
) -> StepResult:
    ensure_schemas(spark, cfg, location_root)
    raw = read_raw_csv(spark, source_path or cfg.source_path)
    bronze = add_audit_columns(raw, batch_id)
    staged = stage_version(bronze, cfg, "bronze", BRONZE_TABLE)
    fqn = publish_version(spark, cfg, staged)
    return StepResult(fqn, _emit("bronze", {"table": fqn, "rows": staged.rows, "batch_id": batch_id}, log))


def run_silver(
    spark: SparkSession,
    cfg: LayerConfig,
    batch_id: str,
    log: Callable[[str], None] = print,
) -> StepResult:
    bronze = read_layer(spark, cfg, "bronze", BRONZE_TABLE)
    # Written as they come first: the shuffles of the cleansing are gone before
    # the partitioned write shuffles all rows again.
    discard_versions(spark, cfg, "silver", KEPT_TABLE)
    kept = stage_version(clean_orders(bronze), cfg, "silver", KEPT_TABLE)
    try:
        staged = stage_version(kept.read(spark), cfg, "silver", SILVER_TABLE, partition_by=["order_date"])
    finally:
        discard_version(spark, kept)
    try:
        check_version(staged, kept.rows)
        # The audit reads one column of the files that are to be published.
        report = profile(bronze, staged.read(spark))
        decided = verdict(report, cfg.max_rejection_rate, cfg.fail_on_violation, cfg.env, keep_counts=True).first()
        check_version(staged, decided["output_rows"])
        apply_gate(decided, log)
    except Exception:
        discard_version(spark, staged)
        raise
    fqn = publish_version(spark, cfg, staged)
    return StepResult(fqn, _emit("silver", {"table": fqn, "batch_id": batch_id, **{c: decided[c] for c in report.columns}}, log))


def run_gold(
    spark: SparkSession,
    cfg: LayerConfig,
    batch_id: str,
    log: Callable[[str], None] = print,
) -> StepResult:
    silver = read_layer(spark, cfg, "silver", SILVER_TABLE)
    # Silver has one row per order; the table promises no order of rows.
    gold = daily_country_sales(silver, sort=False, unique_orders=True)
    staged = stage_version(gold, cfg, "gold", GOLD_TABLE)
    fqn = publish_version(spark, cfg, staged)
    return StepResult(fqn, _emit("gold", {"table": fqn, "rows": staged.rows, "batch_id": batch_id}, log))


def run_all(
    spark: SparkSession,
    cfg: LayerConfig,
    batch_id: str | None = None,
    source_path: str | None = None,
    location_root: str | None = None,
    log: Callable[[str], None] = print,
) -> list[StepResult]:
    """Bronze, silver and gold in order; stops at a strict gate failure."""
    batch = batch_id or default_batch_id()
    return [
        run_bronze(spark, cfg, batch, source_path, location_root, log),
        run_silver(spark, cfg, batch, log),
        run_gold(spark, cfg, batch, log),
    ]
