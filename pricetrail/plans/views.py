"""The published views and table functions over a price fact, items and a usage log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from pricetrail.functions.table_functions import register_item_prices, register_item_search
from pricetrail.operators.curves import BEFORE, NAMED_SETS, SCARCE, curve_from_state, launch_curve
from pricetrail.operators.usage import cost_daily, cost_rollup

# View name -> arguments of launch_curve where they differ from its defaults.
LAUNCH_VIEWS: dict[str, dict] = {
    "price_after_launch": {},
    "price_after_launch_foil": {"price": "usd_foil"},
    "price_after_launch_rare_mythic": {"rarities": SCARCE},
    "price_after_launch_foil_rare_mythic": {"price": "usd_foil", "rarities": SCARCE},
    "price_after_launch_variable": {"set_names": NAMED_SETS, "by_rarity": True, "released_from": None},
    "price_before_launch": {"days": BEFORE},
    "price_before_launch_foil": {"price": "usd_foil", "days": BEFORE},
}


def launch_views(prices: DataFrame, items: DataFrame, **overrides) -> dict[str, DataFrame]:
    """All launch curves; ``overrides`` replace a default where a view has not set its own.

    Nothing runs here: a view may live long, so Spark decides on broadcasts when it is read.
    """
    settings = {"broadcast_rows": 0, **overrides}
    return {name: launch_curve(prices, items, **{**settings, **own}) for name, own in LAUNCH_VIEWS.items()}


def launch_views_from_state(state: DataFrame, **overrides) -> dict[str, DataFrame]:
    """All launch curves from kept sums."""
    return {name: curve_from_state(state, **{**overrides, **own}) for name, own in LAUNCH_VIEWS.items()}


def register_views(
    spark: SparkSession,
    prices: DataFrame,
    items: DataFrame,
    usage: DataFrame,
    as_of: date | None = None,
    prices_name: str = "item_prices",
    items_name: str = "items",
) -> None:
    """Make every view and table function callable from Spark SQL.

    Without ``as_of`` the rolling cost view follows the current date.
    """
    prices.createOrReplaceTempView(prices_name)
    items.createOrReplaceTempView(items_name)
    for name, view in launch_views(prices, items).items():
        view.createOrReplaceTempView(name)
    cost_daily(usage).createOrReplaceTempView("daily_compute_costs")
    cost_rollup(usage, as_of).createOrReplaceTempView("rolling_compute_costs")
    id_type = items.schema["id"].dataType.simpleString()
    register_item_prices(spark, prices_name, items_name, id_type=id_type)
    register_item_search(spark, prices_name, items_name, id_type=id_type)
