"""From the nested snapshot to the price fact and the item dimension."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.schemas import ITEM_FLAGS, ITEM_LISTS, ITEM_NUMBERS, LANDING_ITEMS, WIDE_COLUMNS


def quoted_prices(raw: DataFrame) -> DataFrame:
    """Item id with both prices as the snapshot spells them."""
    return raw.select("id", F.col("prices.usd").alias("usd"), F.col("prices.usd_foil").alias("usd_foil"))


def daily_prices(raw: DataFrame, as_of: date) -> DataFrame:
    """Landing price rows of one day.

    Items with at least one quoted price stay, also if the text turns out not to be a number.
    """
    quoted = quoted_prices(raw).filter(F.col("usd").isNotNull() | F.col("usd_foil").isNotNull())
    return quoted.select(
        "id",
        F.col("usd").try_cast("double").alias("usd"),
        F.col("usd_foil").try_cast("double").alias("usd_foil"),
        F.lit(as_of.isoformat()).alias("pull_date"),
    )


def static_fields(raw: DataFrame, as_of: date) -> DataFrame:
    """Landing item rows of one day, all items."""
    stamped = raw.withColumn("pull_date", F.lit(as_of.isoformat()))
    return stamped.select(
        [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in LANDING_ITEMS]
    )


def wide_schema(numbers: str = "int") -> dict[str, str]:
    """Column -> type of the wide item table, in table order."""
    types = {name: numbers for name in ITEM_NUMBERS} | {name: "boolean" for name in ("highres_image", *ITEM_FLAGS)}
    types |= {name: "date" for name in ("released_at", "preview_previewed_at", "pull_date")}
    return {name: types.get(name, "string") for name in WIDE_COLUMNS}


def _wide_value(column: str, as_of: date) -> Column:
    """Where a wide column comes from: a list, a nested field, a face, or its namesake."""
    if column == "pull_date":
        return F.lit(as_of)
    if column == "set_code":
        return F.col("`set`")
    if column in ITEM_LISTS:
        return F.array_join(column, ",")
    for struct in ("legalities", "preview", "image_uris", "purchase_uris"):
        if column.startswith(f"{struct}_"):
            return F.col(f"{struct}.{column.removeprefix(struct + '_')}")
    for position, side in enumerate(("front", "back"), start=1):
        if column.startswith(f"card_faces_{side}_"):
            face = F.try_element_at("card_faces", F.lit(position))
            return face[column.removeprefix(f"card_faces_{side}_")]
    return F.col(column)


def flatten_wide(raw: DataFrame, as_of: date, numbers: str = "int", more: Iterable[str] = ()) -> DataFrame:
    """The 101-column item table: nested fields by path, lists as text, two faces.

    A missing second face, list or struct gives NULL.  Whole numbers get the type ``numbers``; the
    fields ``more`` follow as they are.
    """
    return raw.select(
        *[_wide_value(name, as_of).try_cast(kind).alias(name) for name, kind in wide_schema(numbers).items()],
        *[F.col(f"`{name}`") for name in more],
    )
