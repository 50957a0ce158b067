"""The daily run: snapshot to landing files, curated tables and the movers report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from pricetrail.operators.conform import conform
from pricetrail.operators.flatten import daily_prices, static_fields
from pricetrail.operators.merge import newest_per_item
from pricetrail.operators.movers import price_movers
from pricetrail.plans.loads import merge_items, merge_prices, one_row
from pricetrail.plans.maintained import Maintained
from pricetrail.schemas import ITEM_RENAMES, ITEMS
from pricetrail.sources.landing import (
    Stage,
    day_path,
    item_stage,
    open_prices,
    price_stage,
    publish_csv,
    write_counted,
    write_day,
)
from pricetrail.sources.versions import VersionedTable
from pricetrail.sources.snapshots import parse_snapshot, readable, unreadable


@dataclass(frozen=True)
class Lake:
    """Where the tables of one installation live."""

    base: str

    @property
    def landing_prices(self) -> Stage:
        return price_stage(f"{self.base}/landing_prices")

    @property
    def landing_items(self) -> Stage:
        return item_stage(f"{self.base}/landing_items")

    @property
    def prices(self) -> str:
        return f"{self.base}/prices"

    @property
    def ledger(self) -> str:
        return f"{self.base}/ledger"

    def report(self, day: date) -> str:
        """The movers report of one day; the newest day's is the current one."""
        return day_path(f"{self.base}/report", day)

    def items(self, spark: SparkSession) -> VersionedTable:
        return VersionedTable(spark, f"{self.base}/items", ITEMS)


def land_snapshot(spark: SparkSession, raw: DataFrame, lake: Lake, day: date) -> DataFrame:
    """Write both landing datasets of one day from one parse of the snapshot.

    Returns (dataset, row_count).  Both counts come from the writes themselves.  What ``raw`` is
    parsed from should be kept by the caller, since both writes read it.
    """
    n_prices = write_day(daily_prices(raw, day), lake.landing_prices.path, day, "none")
    n_items = write_day(static_fields(raw, day), lake.landing_items.path, day, "snappy")
    return one_row(spark, dataset="prices", row_count=n_prices).unionByName(
        one_row(spark, dataset="items", row_count=n_items)
    )


def run_day(
    spark: SparkSession, snapshot_path: str, lake: Lake, day: date, layout: str = "lines", maintained: Maintained | None = None
) -> DataFrame:
    """Everything one day needs; safe to repeat for the same or a past day.

    Returns (dataset, row_count) of the landing files, of the rows merged, and of what was left
    out and kept aside: unreadable records, price rows unfit to load, items without id.
    The report is the day's own: it shows the items as that day's snapshot had them.
    ``maintained`` are states that follow the fact, such as the copy by item; they take in the day's new prices.
    """
    parsed = parse_snapshot(spark, snapshot_path, layout=layout).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        landed = land_snapshot(spark, readable(parsed), lake, day)
        lost = write_counted(
            unreadable(parsed), lambda writer: writer.mode("overwrite").text(day_path(f"{lake.base}/unreadable", day))
        )
    finally:
        parsed.unpersist()
    rejects = day_path(f"{lake.base}/rejects", day)
    merged = merge_prices(spark, lake.landing_prices.read_day(spark, day), lake.prices, rejects, maintained)
    changed = merge_items(spark, lake.landing_items, lake.items(spark), day)
    items = conform(lake.landing_items.read_day(spark, day), ITEMS, ITEM_RENAMES)
    items = newest_per_item(items.filter(F.col("id").isNotNull()))
    report = price_movers(open_prices(spark, lake.prices), items, day)
    publish_csv(report, lake.report(day), F.desc_nulls_last("4wk_diff"), F.col("id"))
    counts = {
        "prices merged": merged["rows_inserted"],
        "items merged": changed["rows_merged"],
        "records unreadable": lost,
        "prices rejected": merged["rows_rejected"],
        "items rejected": changed["rows_rejected"],
    }
    for dataset, rows in counts.items():
        landed = landed.unionByName(one_row(spark, dataset=dataset, row_count=rows))
    return landed
