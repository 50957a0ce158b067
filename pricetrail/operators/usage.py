"""Cost reports over the usage log."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.functions.columns import days_before

# Fixed value: currency units per credit.
CREDIT_RATE = Decimal("2")


def usage_recent(log: DataFrame) -> DataFrame:
    """The whole log, newest first; entries of one time by their other columns."""
    others = [F.asc_nulls_last(name) for name in log.columns if name != "start_time"]
    return log.orderBy(F.desc_nulls_last("start_time"), *others)


def _credits() -> Column:
    return F.sum("credits_used")


def _cost(rate: Decimal) -> Column:
    # Multiplied as decimals: an exact sum, rounded once.
    return F.round(_credits() * F.lit(rate), 2)


def _with_day(log: DataFrame) -> DataFrame:
    return log.withColumn("day", F.to_date("start_time"))


def cost_by_day_resource(log: DataFrame, rate: Decimal = CREDIT_RATE) -> DataFrame:
    grouped = _with_day(log).groupBy("day", "warehouse_name")
    costs = grouped.agg(_credits().alias("credits_used"), _cost(rate).alias("cost"))
    return costs.orderBy(F.desc_nulls_last("day"), F.desc_nulls_last("credits_used"), "warehouse_name")


def cost_by_resource(log: DataFrame, rate: Decimal = CREDIT_RATE) -> DataFrame:
    grouped = log.groupBy("warehouse_name")
    costs = grouped.agg(_credits().alias("credits_used"), _cost(rate).alias("cost"))
    return costs.orderBy(F.desc_nulls_last("credits_used"), "warehouse_name")


def cost_daily(log: DataFrame, rate: Decimal = CREDIT_RATE) -> DataFrame:
    grouped = _with_day(log).groupBy("day")
    costs = grouped.agg(_cost(rate).alias("daily_usd"), _credits().alias("daily_credits"))
    return costs.orderBy(F.desc_nulls_last("day"))


def cost_rollup(
    log: DataFrame, as_of: date | None = None, days: int = 30, rate: Decimal = CREDIT_RATE
) -> DataFrame:
    """Cost per day of the trailing window, and one row 'All' with the total."""
    window = _with_day(log.filter(F.col("start_time") >= days_before(as_of, days)))
    rolled = window.rollup("day").agg(
        F.grouping_id().alias("level"),
        _cost(rate).alias("daily_usd"),
        _credits().alias("daily_credits"),
    )
    label = F.when(F.col("level") == 1, F.lit("All")).otherwise(F.date_format("day", "yyyy-MM-dd"))
    return rolled.select(label.alias("day"), "daily_usd", "daily_credits").orderBy(F.desc_nulls_last("day"))
