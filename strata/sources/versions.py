"""Write, audit, publish: a layer's next version is written beside the current one.

A layer name is a view on one version, which is a table of its own
(``<name>__v<time>_<random>``). A version is staged first: its files are
complete before anything can see them. What was written can then be audited
on those files. Publishing replaces the view, one catalogue operation, so a
reader finds the old rows or the new ones, whole, at any time; a job lost
before that leaves the layer as it was, and its files go with the next
publication.

One writer per layer table at a time. The version before the current one is
kept for readers that began with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.config import LayerConfig
from strata.session import released_shuffles

_MARK = "__v"


class IncompleteVersionError(RuntimeError):
    """The files of a staged version don't hold the rows that were written."""


@dataclass(frozen=True)
class StagedVersion:
    """A version that is written but not published; ``measures`` were taken while writing."""

    layer: str
    name: str
    table: str
    measures: Mapping[str, object] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return int(self.measures["rows"])

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.table(self.table)


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _version_name(name: str) -> str:
    """Versions sort by the time at which they were begun."""
    return f"{name}{_MARK}{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:6]}"


def stage_version(
    df: DataFrame,
    cfg: LayerConfig,
    layer: str,
    name: str,
    partition_by: Sequence[str] | None = None,
    measures: Mapping[str, Column] | None = None,
) -> StagedVersion:
    """Write ``df`` as the next version of a layer table, unseen under the layer's name.

    Row count and ``measures`` (aggregates) come from an ``Observation`` in
    the stage that writes, not from another job, and its shuffle files go
    with the write. With ``partition_by`` the rows are first rebalanced on
    those columns: every task then writes few partition folders, and AQE
    splits a partition value that holds a large share of the rows over
    several tasks instead of one.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    observation = Observation(f"{layer}-{name}")
    counted = {"rows": F.count(F.lit(1)), **(measures or {})}
    df = df.observe(observation, *[column.alias(label) for label, column in counted.items()])
    writer = df.write.format(cfg.table_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    table = cfg.table(layer, _version_name(name))
    with released_shuffles(df.sparkSession):
        writer.saveAsTable(table)
    return StagedVersion(layer, name, table, dict(observation.get))


def layer_versions(spark: SparkSession, cfg: LayerConfig, layer: str, name: str) -> list[str]:
    """Qualified names of all versions of a layer table, oldest first."""
    found = spark.sql(f"SHOW TABLES IN {quoted(cfg.namespace(layer))} LIKE '{name.lower()}{_MARK}*'")
    # One row for each version: the current one, the one before, and what lost jobs left.
    return [cfg.table(layer, r["tableName"]) for r in found.orderBy("tableName").collect()]


def check_version(staged: StagedVersion, rows_in_files: int) -> None:
    """Raises unless the files hold as many rows as were written."""
    if rows_in_files != staged.rows:
        raise IncompleteVersionError(f"{staged.table}: wrote {staged.rows} rows, its files hold {rows_in_files}")


def publish_version(spark: SparkSession, cfg: LayerConfig, staged: StagedVersion, keep: int = 1) -> str:
    """Point the layer's name at a staged version; drop versions older than the ``keep`` before it.

    A plain table of that name, as written before there were versions,
    becomes the oldest version. Versions begun after this one are left alone.
    """
    fqn = cfg.table(staged.layer, staged.name)
    if spark.catalog.tableExists(fqn) and spark.catalog.getTable(fqn).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {quoted(fqn)} RENAME TO {quoted(f'{fqn}{_MARK}0')}")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(fqn)} AS SELECT * FROM {quoted(staged.table)}")
    older = [v for v in layer_versions(spark, cfg, staged.layer, staged.name) if v.lower() < staged.table.lower()]
    for version in older[: max(0, len(older) - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(version)}")
    return fqn


def discard_version(spark: SparkSession, staged: StagedVersion) -> None:
    """Drop a staged version that is not to be published."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(staged.table)}")


def discard_versions(spark: SparkSession, cfg: LayerConfig, layer: str, name: str) -> None:
    """Drop all versions of a table that is never published: what lost jobs left of it."""
    for version in layer_versions(spark, cfg, layer, name):
        spark.sql(f"DROP TABLE IF EXISTS {quoted(version)}")
