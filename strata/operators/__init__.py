"""DataFrame -> DataFrame operators."""

from strata.operators.cleanse import (
    add_audit_columns,
    clean_orders,
    derive_amount,
    normalise_orders,
    valid_orders,
)
from strata.operators.dedupe import deduplicate_latest
from strata.operators.marts import daily_country_sales

__all__ = [
    "add_audit_columns",
    "clean_orders",
    "daily_country_sales",
    "deduplicate_latest",
    "derive_amount",
    "normalise_orders",
    "valid_orders",
]
