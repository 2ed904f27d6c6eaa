"""Bronze audit columns and the silver cleansing steps.

``clean_orders`` = normalise -> validate -> keep the latest row per
``order_id`` -> derive amount/date. Each step is also public on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from strata.functions.columns import is_blank
from strata.operators.dedupe import deduplicate_latest

# Columns that break ties between rows of one order with the same order_ts,
# so that the kept row never depends on task scheduling.
ORDER_TIE_BREAKERS = ("product_id", "quantity", "unit_price", "customer_id", "country")


def _source_file(df: DataFrame, detail: str) -> Column:
    field = {"path": "file_path", "name": "file_name"}[detail]
    try:
        df.select(F.col(f"_metadata.{field}")).schema  # resolves only on file scans
    except AnalysisException:
        return F.lit("")
    return F.col(f"_metadata.{field}")


def add_audit_columns(df: DataFrame, batch_id: str, source_detail: str = "path") -> DataFrame:
    """Attach ``_ingested_at``, ``_source_file`` and ``_batch_id``; row count unchanged.

    ``_ingested_at`` is one timestamp per query. ``_source_file`` is the
    scanned file's path (``source_detail="name"``: its base name), or ``''``
    when the rows do not come from a file scan.
    """
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_file": _source_file(df, source_detail),
            "_batch_id": F.lit(batch_id),
        }
    )


def normalise_orders(df: DataFrame) -> DataFrame:
    """Trim the three keys (spaces only) and upper-case the trimmed country."""
    return df.withColumns(
        {
            "order_id": F.trim(F.col("order_id")),
            "customer_id": F.trim(F.col("customer_id")),
            "product_id": F.trim(F.col("product_id")),
            "country": F.upper(F.trim(F.col("country"))),
        }
    )


def valid_orders(df: DataFrame) -> DataFrame:
    """Keep rows with an order id, a customer id, and positive quantity and price.

    A NULL quantity or price fails the test. The numeric tests read raw
    columns, so on a table scan they reach the reader as pushed filters.
    """
    return df.filter(
        (F.col("quantity") > F.lit(0))
        & (F.col("unit_price") > F.lit(0))
        & ~is_blank(F.col("order_id"))
        & ~is_blank(F.col("customer_id"))
    )


def derive_amount(df: DataFrame) -> DataFrame:
    """``gross_amount = round(quantity * unit_price, 2)``, ``order_date = to_date(order_ts)``."""
    return df.withColumns(
        {
            "gross_amount": F.round(F.col("quantity") * F.col("unit_price"), 2),
            "order_date": F.to_date(F.col("order_ts")),
        }
    )


def clean_orders(df: DataFrame, tie_breakers: Sequence[str] = ORDER_TIE_BREAKERS, spread: bool = True) -> DataFrame:
    """Raw or bronze orders -> silver: one valid, normalised row per ``order_id``.

    The latest ``order_ts`` wins (NULL times last). Audit columns pass through.
    ``spread``: see ``deduplicate_latest``. Amount and date are derived from
    the kept rows, so that they are not shuffled, unless they break ties.
    """
    valid = valid_orders(normalise_orders(df))
    early = not {"gross_amount", "order_date"}.isdisjoint(c.lower() for c in tie_breakers)
    kept = deduplicate_latest(
        derive_amount(valid) if early else valid, keys=["order_id"], order_by="order_ts", tie_breakers=tie_breakers, spread=spread
    )
    return kept if early else derive_amount(kept)
