"""Reusable column expressions and fixed values."""

from strata.functions.columns import (
    half_up_cents_average,
    is_blank,
    is_cent_amount,
    money_cents,
    python_lines,
    round_like_python,
    strip_whitespace,
)

__all__ = [
    "half_up_cents_average",
    "is_blank",
    "is_cent_amount",
    "money_cents",
    "python_lines",
    "round_like_python",
    "strip_whitespace",
]
