"""Average price by days since (or until) release."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetrail.functions.columns import day_offset, mean_of
from pricetrail.operators.joins import BROADCAST_ROWS, broadcast_if_small

# The defaults of the published views.
SET_TYPES = ("expansion",)
RELEASED_FROM = date(2024, 8, 2)
SCARCE = ("mythic", "rare")
NAMED_SETS = (
    "Tarkir: Dragonstorm",
    "Aetherdrift",
    "Duskmourn: House of Horror",
    "Bloomburrow",
    "Final Fantasy",
)
AFTER = (1, 300)
BEFORE = (-45, 0)


def launch_curve(
    prices: DataFrame,
    items: DataFrame,
    price: str = "usd",
    days: tuple[int, int] = AFTER,
    set_types: Sequence[str] | None = SET_TYPES,
    released_from: date | None = RELEASED_FROM,
    rarities: Sequence[str] | None = None,
    set_names: Sequence[str] | None = None,
    by_rarity: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Mean of ``price`` per day offset and set (and rarity), last day first.

    Items without a price in the range drop out.  A group with rows but no price of this
    kind stays, with NULL.
    """
    first, last = days
    wanted = _selected(items, set_types, released_from, rarities, set_names)
    if released_from is not None:
        # No earlier price can qualify, and on the partition column this prunes files.
        prices = prices.filter(F.col("pull_date") >= F.lit(released_from + timedelta(days=first)))

    keys = ["set_name", "rarity"] if by_rarity else ["set_name"]
    offset = day_offset(F.col("released_at"), F.col("pull_date"))
    wanted = wanted.select("id", "released_at", *keys)
    # On the partition column both bounds of the selected items prune files at run time.
    released = wanted.agg(F.min("released_at").alias("first"), F.max("released_at").alias("last"))
    prices = prices.filter(
        (F.col("pull_date") >= F.date_add(released.select("first").scalar(), first))
        & (F.col("pull_date") <= F.date_add(released.select("last").scalar(), last))
    )
    # Beyond the size for a broadcast this is a shuffle by id, in which Spark splits the
    # tasks of hot items.
    wanted = broadcast_if_small(wanted, broadcast_rows) or wanted
    joined = prices.select("id", "pull_date", price).join(wanted, "id")
    in_range = joined.withColumn("date_diff", offset).filter(F.col("date_diff").between(first, last))
    curve = in_range.groupBy("date_diff", *keys).agg(mean_of(F.col(price)).alias("avg_usd"))
    return curve.select("date_diff", "avg_usd", *keys).orderBy(F.desc("date_diff"), *keys)


def curve_from_state(
    state: DataFrame,
    price: str = "usd",
    days: tuple[int, int] = AFTER,
    set_types: Sequence[str] | None = SET_TYPES,
    released_from: date | None = RELEASED_FROM,
    rarities: Sequence[str] | None = None,
    set_names: Sequence[str] | None = None,
    by_rarity: bool = False,
) -> DataFrame:
    """``launch_curve`` from kept sums (``LaunchState.state``): neither the fact nor the items are read."""
    keys = ["set_name", "rarity"] if by_rarity else ["set_name"]
    wanted = _selected(state, set_types, released_from, rarities, set_names)
    dated = wanted.withColumn("date_diff", day_offset(F.col("released_at"), F.col("pull_date")))
    mean = F.try_divide(F.sum(f"{price}_sum").cast("double"), F.sum(f"{price}_n"))
    curve = dated.filter(F.col("date_diff").between(*days)).groupBy("date_diff", *keys).agg(mean.alias("avg_usd"))
    return curve.select("date_diff", "avg_usd", *keys).orderBy(F.desc("date_diff"), *keys)


def _selected(rows: DataFrame, set_types, released_from, rarities, set_names) -> DataFrame:
    """Rows of the wanted item traits; None leaves a trait open."""
    for name, values in (("set_type", set_types), ("rarity", rarities), ("set_name", set_names)):
        if values is not None:
            rows = rows.filter(F.col(name).isin(list(values)))
    return rows if released_from is None else rows.filter(F.col("released_at") >= F.lit(released_from))
