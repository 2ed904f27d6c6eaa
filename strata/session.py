"""Session helpers for local runs (tests, bench) and the shared scratch folder.

Library operators never set session options. Only ``local_session`` (used by
tests and the bench) configures one; on a cluster the caller's session is used
as it is, but for one option while a step writes (``released_shuffles``).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
# Explicit choice of the session's owner: "true" rebalances the scans of the
# text queries. Unset means no. Never inferred from the data.
SPREAD_CONF = "spark.strata.spreadScans"
# Spark's option (4.1) to delete shuffle files with the query that wrote them.
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """A ``local[cores]`` session with UTC time, AQE on and no web UI.

    Three settings only make sense on one machine with small data: file
    listing stays on the driver (a listing job only pays off on remote
    storage), AQE may coalesce down to 64 KB partitions, so that a
    rebalanced partitioned write of a few MB still uses every core, and the
    text queries rebalance their scans (``SPREAD_CONF``), because a single
    small file would otherwise keep one core busy. A cluster session leaves
    that option unset: its tables have more splits than cores.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
        .config(SPREAD_CONF, "true")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read as is; it
    is an error there to leave it unset, because executors would write to
    their own disks. Only a ``local`` session gets a fresh folder.
    """
    try:
        context = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context, only the SQL conf
        context = None
    configured = context.getCheckpointDir() if context is not None else None
    if not configured:
        configured = spark.conf.get(_CHECKPOINT_CONF, None)
    if not configured and context is not None:
        configured = context.getConf().get(_CHECKPOINT_CONF, None)
    if not configured:
        if context is None or not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError(f"{_CHECKPOINT_CONF} must name a folder that all executors share.")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/strata-{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside it take their shuffle files with them.

    Else those stay until the driver happens to collect its garbage, and the
    disk holds the shuffles of all steps of a job at once. Meant for writes:
    what they shuffle is never read again. The session's own setting is put
    back afterwards.
    """
    before = spark.conf.get(_CLEANUP_CONF, None)
    spark.conf.set(_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_CONF)
        else:
            spark.conf.set(_CLEANUP_CONF, before)
