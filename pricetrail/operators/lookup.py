"""Item search, one item's history, and lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetrail.functions.columns import matches_term, mean_cents, product_url
from pricetrail.operators.joins import broadcast_if_small
from pricetrail.operators.maintained import stat_measures

MAX_MATCHES = 10_000


def item_history(prices: DataFrame, items: DataFrame, item_id) -> DataFrame:
    """All prices of one item by date; the name is NULL if the item is unknown."""
    wanted = F.col("id") == F.lit(item_id)
    # Grouped by the one id this is one row at most: the side that is sent to all tasks has a
    # known size, and the prices stay where they were read.
    named = items.filter(wanted).groupBy("id").agg(F.max("name").alias("name"))
    history = prices.filter(wanted).join(F.broadcast(named), "id", "left")
    return history.select("name", "usd", "usd_foil", "pull_date").orderBy(
        *[F.asc_nulls_last(name) for name in ("pull_date", "usd", "usd_foil")]
    )


def search_items(
    prices: DataFrame,
    items: DataFrame,
    name_term: str | None = None,
    set_term: str | None = None,
    limit: int = MAX_MATCHES,
) -> DataFrame:
    """Items by parts of their name and set name, with price statistics.

    Items without prices stay, with count 0.  If few items match, the prices of all others
    are dropped where they are read; otherwise every item's prices are reduced to one row
    per task first, so that no item is large in the shuffle.
    """
    found = _found(items, name_term, set_term)
    few = broadcast_if_small(found.select("id")) if name_term or set_term else None
    if few is not None:
        prices = prices.join(few, "id", "left_semi")
    stats = prices.groupBy("id").agg(
        F.count(F.lit(1)).alias("records"),
        mean_cents(F.col("usd")).alias("avg_price"),
        F.min("usd").alias("min_price"),
        F.max("usd").alias("max_price"),
        mean_cents(F.col("usd_foil")).alias("avg_foil_price"),
        F.min("usd_foil").alias("min_foil_price"),
        F.max("usd_foil").alias("max_foil_price"),
    )
    return _report(found, stats, limit)


def search_stats(
    stats: DataFrame,
    items: DataFrame,
    name_term: str | None = None,
    set_term: str | None = None,
    limit: int = MAX_MATCHES,
) -> DataFrame:
    """``search_items`` over kept statistics (``ItemStats.current``): the fact is not read."""
    measures = [column.alias(name) for name, column in stat_measures().items()]
    return _report(_found(items, name_term, set_term), stats.select("id", "records", *measures), limit)


def _found(items: DataFrame, name_term: str | None, set_term: str | None) -> DataFrame:
    wanted = matches_term(F.col("name"), name_term) & matches_term(F.col("set_name"), set_term)
    return items.filter(wanted).select("name", "set_name", "id", "tcgplayer_id")


def _report(found: DataFrame, stats: DataFrame, limit: int) -> DataFrame:
    """Items with their statistics, in order, at most ``limit``."""
    measures = ("avg_price", "min_price", "max_price", "avg_foil_price", "min_foil_price", "max_foil_price")
    # Repeated item rows form one group whose counts add up; their other figures are equal.
    grouped = (
        found.join(stats, "id", "left")
        .groupBy("name", "set_name", "id", "tcgplayer_id")
        .agg(
            F.coalesce(F.sum("records"), F.lit(0)).alias("price_records_count"),
            *[F.max(m).cast("decimal(10,2)").alias(m) for m in measures],
        )
    )
    return (
        grouped.orderBy(F.asc_nulls_last("name"), F.asc_nulls_last("set_name"), "id")
        .limit(limit)
        .select(
            "name",
            "set_name",
            "id",
            product_url(F.col("tcgplayer_id")).alias("tcgplayer_url"),
            "price_records_count",
            *measures,
        )
    )


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str = "id") -> DataFrame:
    """Attach a lookup table; rows without an entry stay.

    No broadcast hint: Spark broadcasts the lookup where its own size check allows.
    """
    return rows.join(lookup, key, "left")
