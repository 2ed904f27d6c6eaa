"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "__strata_rank"


def deduplicate_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    tie_breakers: Sequence[str] = (),
    spread: bool = True,
) -> DataFrame:
    """One row per ``keys`` combination: the one with the greatest ``order_by``.

    NULL ``order_by`` values sort last, so a key whose times are all NULL still
    keeps a row. ``tie_breakers`` (ascending, NULLs first) make the choice
    deterministic when several rows share the greatest ``order_by``.

    Written as ``row_number() ... = 1`` on purpose: Spark plans it as a
    partial ``WindowGroupLimit`` before the shuffle and a final one after it,
    so a key holding a large share of the rows sends at most one row per map
    task across the network.

    That partial limit sorts all rows of its task. A scan task holds as many
    as its split does, which a compressed file multiplies, so the rows are
    first rebalanced on key and ordering: AQE sizes those partitions, and
    splits the ones that many equal rows fill. ``spread=False`` leaves that
    shuffle out, for rows that come straight from a shuffle anyway.
    """
    if not keys:
        raise ValueError("deduplicate_latest needs the columns that make up a key")
    if spread:
        df = df.hint("rebalance", *dict.fromkeys([*keys, order_by, *tie_breakers]))
    ordering = [F.col(order_by).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tie_breakers]
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == F.lit(1)).drop(_RANK)
