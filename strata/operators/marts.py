"""Gold mart: daily sales per country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import half_up_cents_average, is_cent_amount, money_cents
from strata.schemas import GOLD_COLUMNS


def daily_country_sales(df: DataFrame, sort: bool = True, unique_orders: bool = False) -> DataFrame:
    """Orders, customers, revenue and average order value per ``(order_date, country)``.

    * ``order_count`` / ``customer_count``: exact distinct counts (NULL ignored).
      With ``unique_orders=True`` the caller states that no ``order_id``
      occurs twice (as after ``clean_orders``): orders are then counted
      plainly, and a single distinct count is left to plan.
    * ``gross_revenue`` = ``round(sum(gross_amount), 2)`` and
      ``avg_order_value`` = ``round(avg(gross_amount), 2)`` (HALF_UP).

    ``gross_amount`` carries two decimals, so money is summed as exact integer
    cents: the result does not depend on the order in which partial sums
    meet, and averages that fall exactly on half a cent round the same way
    every run. A group holding any amount that is not a whole number of
    cents (NaN, infinite, sub-cent fractions, beyond 1e13) or whose cent sum
    overflows falls back to the floating point aggregate, i.e. exactly
    ``round(sum(x), 2)`` / ``round(avg(x), 2)``.

    NULL dates and countries form their own groups. Output is sorted by
    ``order_date, country`` (NULLs first) unless ``sort=False``.
    """
    amount = F.col("gross_amount")
    groups = df.groupBy("order_date", "country").agg(
        (F.count("order_id") if unique_orders else F.count_distinct("order_id")).alias("order_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.try_sum(money_cents(amount)).alias("_cents"),
        F.count(amount).alias("_n"),
        F.count_if(~is_cent_amount(amount)).alias("_odd"),
        F.sum(amount).alias("_dsum"),
    )
    exact = (F.col("_odd") == F.lit(0)) & (F.col("_cents").isNotNull() | (F.col("_n") == F.lit(0)))
    result = groups.select(
        "order_date",
        "country",
        "order_count",
        "customer_count",
        F.when(exact, F.col("_cents") / F.lit(100.0)).otherwise(F.round("_dsum", 2)).alias("gross_revenue"),
        F.when(exact, half_up_cents_average(F.col("_cents"), F.col("_n")))
        .otherwise(F.round(F.col("_dsum") / F.col("_n"), 2))  # avg(x) is sum(x) / count(x)
        .alias("avg_order_value"),
    ).select(*GOLD_COLUMNS)
    return result.orderBy("order_date", "country") if sort else result
