"""The catalogue side of the layers: their schemas, and tables that are replaced as a whole.

A layer's rows are read by its name and replaced by publishing a new version
(see ``strata.sources.versions``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.config import LAYERS, LayerConfig
from strata.sources.versions import publish_version, quoted, stage_version


def ensure_schemas(spark: SparkSession, cfg: LayerConfig, location_root: str | None = None) -> list[str]:
    """Create the three layer schemas if absent (idempotent).

    With ``location_root`` each new schema is placed at
    ``<location_root>/<schema>.db``; existing schemas are left untouched.
    """
    created = []
    for layer in LAYERS:
        namespace = cfg.namespace(layer)
        location = f" LOCATION {_literal(f'{location_root}/{cfg.schema(layer)}.db')}" if location_root else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(namespace)}{location}")
        created.append(namespace)
    return created


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def list_schemas(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    """``SHOW SCHEMAS [IN catalog]`` as a DataFrame (one column, ``namespace``)."""
    return spark.sql(f"SHOW SCHEMAS IN `{catalog}`" if catalog else "SHOW SCHEMAS")


def read_layer(spark: SparkSession, cfg: LayerConfig, layer: str, name: str) -> DataFrame:
    return spark.read.table(cfg.table(layer, name))


def write_layer(
    df: DataFrame, cfg: LayerConfig, layer: str, name: str, partition_by: Sequence[str] | None = None
) -> str:
    """Replace a layer table by ``df`` in one step and return its qualified name."""
    return publish_version(df.sparkSession, cfg, stage_version(df, cfg, layer, name, partition_by))
