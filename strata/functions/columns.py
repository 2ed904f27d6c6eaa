"""Column expressions shared by the operators.

All of these are plain Catalyst expressions (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.splitlines() line boundaries, as a Java regex:
# \r\n, \n, \r, \v (0x0b), \f (0x0c), 0x1c, 0x1d, 0x1e, 0x85, U+2028, U+2029.
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
# The same boundaries minus those a Hadoop line reader already ends lines at.
EXTRA_LINE_BREAKS = r"[\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

# The characters Python's str.strip() removes (str.isspace()):
# \t \n \x0b \x0c \r 0x1c-0x1f space 0x85 0xa0 U+1680 U+2000-U+200A U+2028
# U+2029 U+202F U+205F U+3000.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Cents below this magnitude are exact integers in a double (< 2**53), and
# two-decimal amounts are apart from their neighbours.
_MONEY_LIMIT = 1e13


def is_blank(column: Column) -> Column:
    """NULL, empty, or only spaces. Never NULL itself."""
    return column.isNull() | (F.trim(column) == F.lit(""))


def strip_whitespace(column: Column) -> Column:
    """Remove leading and trailing whitespace like Python's ``str.strip()``.

    ``trim`` with an explicit character set strips any mix of those
    characters from both ends, with no regex.
    """
    return F.trim(column, F.lit(PY_WHITESPACE))


def python_lines(text: Column) -> Column:
    """Split ``text`` into lines exactly as Python's ``str.splitlines()``.

    One trailing line break ends the last line instead of opening an empty
    one, and an empty text has no lines at all.
    """
    body = F.regexp_replace(text, rf"(?:{LINE_BREAKS})\z", "")
    return F.when(text == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAKS))


def is_cent_amount(amount: Column) -> Column:
    """True when ``amount`` is the double nearest to a value of whole cents.

    Dividing the nearest whole number of cents by 100 is correctly rounded,
    so it gives back exactly those amounts and no other. NULL for NULL.
    """
    return (
        ~F.isnan(amount)
        & (F.abs(amount) < F.lit(_MONEY_LIMIT))
        & (F.rint(amount * F.lit(100)) / F.lit(100.0) == amount)
    )


def round_like_python(value: Column, digits: int) -> Column:
    """Python's ``round(x, digits)`` on a double: half-even on the exact binary value.

    ``format_number`` rounds that way (``round(0.03125, 4)`` is ``0.0312``);
    Spark's ``round`` rounds half-up on the shortest decimal text instead.
    """
    return F.regexp_replace(F.format_number(value, digits), ",", "").cast("double")


def money_cents(amount: Column) -> Column:
    """A two-decimal amount as exact integer cents; NULL when it is not one."""
    return F.when(is_cent_amount(amount), F.rint(amount * F.lit(100)).cast("bigint"))


def half_up_cents_average(cents_sum: Column, count: Column) -> Column:
    """``round(cents_sum / count / 100, 2)`` with HALF_UP, in exact integer arithmetic.

    Equals Spark's ``round(avg(amount), 2)`` on amounts with two decimals,
    without the double-rounding and summation-order effects of a floating
    point average. NULL when ``count`` is 0.
    """
    total = F.abs(cents_sum)
    rest = total % count
    rounded = F.call_function("div", total, count) + F.when(rest >= count - rest, F.lit(1)).otherwise(F.lit(0))
    return F.when(count > F.lit(0), F.signum(cents_sum) * rounded / F.lit(100.0))
