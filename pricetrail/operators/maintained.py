"""Aggregates that can be kept up to date: mergeable sums, counts and extremes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.schemas import ITEM_STATS, LAUNCH_STATE

KINDS = ("usd", "usd_foil")
SUM = "decimal(20,2)"
LAUNCH_KEYS = ("pull_date", "released_at", "set_name", "set_type", "rarity")
TRAITS = ("released_at", "set_name", "set_type", "rarity")


def _sums(sign: Column) -> list[Column]:
    """Rows, and sum and number of each kind of price, counted ``sign`` times."""
    out = [F.sum(sign).cast("bigint").alias("records")]
    for kind in KINDS:
        signed = F.when(sign < 0, -F.col(kind)).otherwise(F.col(kind))
        out.append(F.coalesce(F.sum(signed), F.lit(0)).cast(SUM).alias(f"{kind}_sum"))
        out.append(F.sum(F.when(F.col(kind).isNotNull(), sign).otherwise(0)).cast("bigint").alias(f"{kind}_n"))
    return out


def _added() -> list[Column]:
    names = ["records", *[f"{kind}_{part}" for kind in KINDS for part in ("sum", "n")]]
    return [F.sum(name).cast(SUM if name.endswith("_sum") else "bigint").alias(name) for name in names]


def item_stats(prices: DataFrame) -> DataFrame:
    """Per item: rows, sum, number, least and greatest of both kinds of price."""
    extremes = [f(kind).alias(f"{kind}_{name}") for kind in KINDS for name, f in (("min", F.min), ("max", F.max))]
    return prices.groupBy("id").agg(*_sums(F.lit(1)), *extremes).select(ITEM_STATS.fieldNames())


def merged_stats(*parts: DataFrame) -> DataFrame:
    """Statistics of all rows together.  The fact is insert-only, so extremes only ever widen."""
    extremes = [f(f"{kind}_{name}").alias(f"{kind}_{name}") for kind in KINDS for name, f in (("min", F.min), ("max", F.max))]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("id").agg(*_added(), *extremes).select(ITEM_STATS.fieldNames())


def stat_measures() -> dict[str, Column]:
    """The measures of a search over statistics; means are rounded once, half up."""
    measures = {}
    for kind, name in zip(KINDS, ("price", "foil_price"), strict=True):
        mean = F.try_divide(F.col(f"{kind}_sum"), F.col(f"{kind}_n"))
        measures |= {
            f"avg_{name}": F.round(mean, 2).cast("decimal(10,2)"),
            f"min_{name}": F.col(f"{kind}_min"),
            f"max_{name}": F.col(f"{kind}_max"),
        }
    return measures


def traits(items: DataFrame) -> DataFrame:
    """What the launch curves need of an item.  Ids are distinct, as an item table has them."""
    return items.filter(F.col("id").isNotNull()).select("id", *TRAITS)


def changed_traits(old: DataFrame, new: DataFrame) -> DataFrame:
    """id and the structs ``old`` and ``new`` of items whose traits differ; null where there is no such item."""
    sides = [rows.select("id", F.struct(*TRAITS).alias(name)) for name, rows in (("old", old), ("new", new))]
    both = sides[0].join(sides[1], "id", "full_outer")
    return both.filter(~F.col("old").eqNullSafe(F.col("new")))


def launch_rows(prices: DataFrame, items: DataFrame) -> DataFrame:
    """Rows, sums and numbers of prices by day and by the traits of their items."""
    joined = prices.select("id", "pull_date", *KINDS).join(items, "id")
    return joined.groupBy(*LAUNCH_KEYS).agg(*_sums(F.lit(1))).select(LAUNCH_STATE.fieldNames())


def moved_launch_rows(prices: DataFrame, changed: DataFrame) -> DataFrame:
    """What ``launch_rows`` changes by when items take other traits: less under the old, more under the new."""
    sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("t")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("t")))
    signed = changed.select("id", F.explode(sides).alias("side")).filter(F.col("side.t").isNotNull())
    joined = prices.select("id", "pull_date", *KINDS).join(signed, "id")
    rows = joined.select("pull_date", *KINDS, F.col("side.sign").alias("sign"), "side.t.*")
    return rows.groupBy(*LAUNCH_KEYS).agg(*_sums(F.col("sign"))).select(LAUNCH_STATE.fieldNames())


def merged_launch(*parts: DataFrame) -> DataFrame:
    """The parts added up; groups whose rows have all moved away are gone."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*LAUNCH_KEYS).agg(*_added()).filter(F.col("records") != 0).select(LAUNCH_STATE.fieldNames())
