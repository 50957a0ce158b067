"""Price now against one, two and four weeks ago."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetrail.functions.columns import days_before, price_ratio, product_url, years_before
from pricetrail.operators.merge import one_per_key

WEEKS = (1, 2, 4)
ITEM_COLUMNS = ("name", "set_name", "set_type", "released_at", "tcgplayer_id")


def priced_on_lookbacks(prices: DataFrame, as_of: date | None, weeks=WEEKS) -> DataFrame:
    """Non-zero prices of the run date and the lookback dates; prunes to those partitions."""
    dates = [days_before(as_of, 7 * n) for n in (0, *weeks)]
    return prices.filter(
        F.col("pull_date").isin(dates) & F.col("usd").isNotNull() & (F.col("usd") != 0)
    )


def recent_items(items: DataFrame, as_of: date | None, years: int = 10) -> DataFrame:
    return items.filter(F.col("released_at") >= years_before(as_of, years))


def lookback_slice(
    prices: DataFrame, items: DataFrame, as_of: date | None = None, weeks=WEEKS, years: int = 10
) -> DataFrame:
    """The price rows of the lookback dates with their item fields."""
    slice_ = priced_on_lookbacks(prices, as_of, weeks).join(recent_items(items, as_of, years), "id")
    return slice_.select(
        "id",
        F.col("tcgplayer_id").try_cast("bigint").alias("tcgplayer_id"),
        "name",
        "set_name",
        "set_type",
        "released_at",
        "usd",
        prices["pull_date"],
    )


def _pivot(as_of: date | None, weeks) -> list:
    """Price columns of one item: today and each lookback, NULL where there is no row."""

    def price_at(days):
        return F.max(F.when(F.col("pull_date") == days_before(as_of, days), F.col("usd")))

    return [
        price_at(0).alias("today_price"),
        *[price_at(7 * n).alias(f"{n}wk_ago_price") for n in weeks],
    ]


def _report(pivoted: DataFrame, as_of: date | None, weeks) -> DataFrame:
    today = F.col("today_price")
    rows = pivoted.select(
        "id",
        product_url(F.col("tcgplayer_id")).alias("tcgplayer_id"),
        "name",
        "set_name",
        "set_type",
        "released_at",
        "today_price",
        days_before(as_of, 0).alias("today_price_date"),
        *[F.col(f"{n}wk_ago_price") for n in weeks],
        *[price_ratio(today, F.col(f"{n}wk_ago_price")).alias(f"{n}wk_diff") for n in weeks],
    )
    return rows.orderBy(F.desc_nulls_last(f"{max(weeks)}wk_diff"), "id")


def price_movers(
    prices: DataFrame,
    items: DataFrame,
    as_of: date | None = None,
    weeks=WEEKS,
    years: int = 10,
    min_price: int = 1,
) -> DataFrame:
    """One row per item with a price today of at least ``min_price``.

    The pivot comes before the join: partial aggregation shrinks each item to one row per
    task, the price floor drops items, and only then are item fields attached.  The grouping
    by id is also the partitioning of the join.
    """
    pivoted = (
        priced_on_lookbacks(prices, as_of, weeks)
        .groupBy("id")
        .agg(*_pivot(as_of, weeks))
        .filter(F.col("today_price") >= min_price)
    )
    known = recent_items(items, as_of, years).select("id", *ITEM_COLUMNS)
    described = one_per_key(known, ("id",), *[F.asc_nulls_last(c) for c in ITEM_COLUMNS])
    return _report(pivoted.join(described, "id"), as_of, weeks)


def movers_from_slice(
    slice_: DataFrame, as_of: date | None = None, weeks=WEEKS, min_price: int = 1
) -> DataFrame:
    """The same report from a ``lookback_slice`` that has been written out.

    In one plan use ``price_movers``: it reduces a hot item before the join, not after it.
    """
    fields = F.min(F.struct(*ITEM_COLUMNS)).alias("item")
    pivoted = slice_.groupBy("id").agg(*_pivot(as_of, weeks), fields)
    pivoted = pivoted.filter(F.col("today_price") >= min_price).select("*", "item.*")
    return _report(pivoted, as_of, weeks)


def top_movers(movers: DataFrame, k: int = 10, by: str = "4wk_diff") -> DataFrame:
    """The k largest rises and the k largest falls; each side is a top-k per task first."""
    rated = movers.filter(F.col(by).isNotNull())
    sides = [
        rated.orderBy(order, "id").limit(k).withColumn("direction", F.lit(direction))
        for direction, order in (("up", F.desc(by)), ("down", F.asc(by)))
    ]
    return sides[0].unionByName(sides[1])
