"""The plans that the operators are written for."""

from __future__ import annotations

import re
from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from pricetrail.operators.curves import launch_curve
from pricetrail.operators.lookup import item_history, search_items
from pricetrail.operators.merge import classified_upsert, new_price_rows, one_per_key
from pricetrail import configure
from pricetrail.functions.table_functions import register_item_search
from pricetrail.operators.movers import lookback_slice, price_movers, top_movers
from pricetrail.operators.usage import cost_daily
from pricetrail.plans.views import launch_views

AS_OF = date(2025, 1, 29)
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@contextmanager
def settings(spark, values):
    old = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df) -> str:
    df.collect()
    text = plan_of(df)
    return text.split("== Initial Plan ==")[0]


def hash_shuffles(text) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A month of prices in which one item holds a third of all rows, and 500 items."""
    base = str(tmp_path_factory.mktemp("plans"))
    spread = spark.range(0, 30_000, 1, 8)
    item = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    prices = spread.select(
        F.concat(F.lit("i"), item.cast("string")).alias("id"),
        (F.col("id") % 97 + 1).cast("decimal(10,2)").alias("usd"),
        (F.col("id") % 89 + 1).cast("decimal(10,2)").alias("usd_foil"),
        F.date_sub(F.lit(AS_OF), (F.col("id") % 31).cast("int")).alias("pull_date"),
    )
    prices.write.partitionBy("pull_date").parquet(f"{base}/prices")
    items = spark.range(0, 500, 1, 2).select(
        F.concat(F.lit("i"), F.col("id").cast("string")).alias("id"),
        F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"),
        F.concat(F.lit("set "), (F.col("id") % 5).cast("string")).alias("set_name"),
        F.lit("expansion").alias("set_type"),
        F.date_sub(F.lit(AS_OF), (F.col("id") % 40).cast("int")).alias("released_at"),
        F.lit("rare").alias("rarity"),
        F.col("id").cast("decimal(10,0)").alias("tcgplayer_id"),
    )
    items.write.parquet(f"{base}/items")
    schema = "id STRING, usd DECIMAL(10,2), usd_foil DECIMAL(10,2), pull_date DATE"
    return spark.read.schema(schema).parquet(f"{base}/prices"), spark.read.parquet(f"{base}/items")


def test_slice_reads_four_partitions_and_two_columns(tables):
    text = plan_of(lookback_slice(*tables, AS_OF))
    assert "PartitionFilters: [pull_date" in text
    for day in ("2025-01-29", "2025-01-22", "2025-01-15", "2025-01-01"):
        assert day in text
    assert "ReadSchema: struct<id:string,usd:decimal(10,2)>" in text


def test_movers_shuffle_each_side_once(spark, tables):
    with settings(spark, NO_BROADCAST):
        text = plan_of(price_movers(*tables, AS_OF))
    assert "SortMergeJoin" in text and hash_shuffles(text) == 2
    # The pivot is partial before its shuffle, so an item is one row per task there.
    shuffle, partial = r"Exchange hashpartitioning\(id#\d+, 4\)", r"HashAggregate\(keys=\[id#\d+\], functions=\[partial_max"
    assert re.search(f"{shuffle}.*\\n.*{partial}", text)


def test_movers_broadcast_small_items(tables):
    text = plan_of(price_movers(*tables, AS_OF))
    assert "BroadcastHashJoin" in text


def test_top_movers_compute_the_movers_once(tables):
    text = final_plan(top_movers(price_movers(*tables, AS_OF)))
    assert text.count("TakeOrderedAndProject") == 2
    assert "ReusedExchange" in text or "ReusedQueryStage" in text


def test_curve_prunes_by_the_release_floor(tables):
    text = plan_of(launch_curve(*tables, released_from=date(2025, 1, 20)))
    assert "pull_date#" in text and ">= 2025-01-21)" in text.split("PartitionFilters")[1].split("]")[0]
    assert "Inner" in text and "LeftOuter" not in text
    assert "usd_foil" not in text


def test_curve_splits_a_hot_item(spark, tables):
    plain = rows(launch_curve(*tables))
    small = {
        **NO_BROADCAST,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    with settings(spark, small):
        curve = launch_curve(*tables, broadcast_rows=0)
        text = final_plan(curve)
        assert "skew=true" in text and "ShuffledHashJoin" in text
        assert rows(curve) == plain


def test_curve_broadcasts_a_small_selection(spark, tables):
    with settings(spark, NO_BROADCAST):  # as if the item files were too large for Spark's own check
        assert "BroadcastHashJoin" in plan_of(launch_curve(*tables))
        assert "SortMergeJoin" in plan_of(launch_curve(*tables, broadcast_rows=499))


def test_selective_search_drops_prices_before_aggregating(spark, tables):
    with settings(spark, NO_BROADCAST):
        text = plan_of(search_items(*tables, "name 1", "set"))
    assert re.search(r"partial_count\(1\)[^\n]*\n[^\n]*(Project[^\n]*\n[^\n]*)?BroadcastHashJoin[^\n]*LeftSemi", text)
    assert "TakeOrderedAndProject" in text
    assert "Contains(lower(name" in text


def test_wide_search_aggregates_before_the_join(spark, tables):
    with settings(spark, NO_BROADCAST):
        text = plan_of(search_items(*tables))
    assert "LeftSemi" not in text
    assert text.index("partial_count(1)") > text.index("SortMergeJoin")


def test_history_pushes_the_id(tables):
    text = plan_of(item_history(*tables, "i7"))
    assert text.count("EqualTo(id,i7)") == 2
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_merge_prunes_the_target_at_run_time(spark, tables):
    prices, _ = tables
    source = prices.withColumn("pull_date", F.date_add("pull_date", 10))
    text = plan_of(new_price_rows(prices, source, keyless=False))
    assert re.search(r"PartitionFilters: \[[^\n]*array_contains\(Subquery", text)
    # Two distant dates: only their two partitions are read.
    ends = prices.filter(F.col("pull_date").isin(AS_OF, date(2024, 12, 30)))
    fresh = new_price_rows(prices, ends.withColumn("id", F.concat("id", F.lit("x"))), keyless=False)
    fresh.collect()
    days = prices.filter(F.array_contains(ends.agg(F.collect_set("pull_date")).scalar(), F.col("pull_date")))
    assert days.select("pull_date").distinct().count() == 2
    with settings(spark, NO_BROADCAST):
        text = plan_of(new_price_rows(prices, source, prune=False, keyless=False))
    assert hash_shuffles(text) == 2  # removing copies and the anti-join share the source's


def test_curve_bounds_come_from_the_items(spark, tables):
    curve = launch_curve(*tables, released_from=None, set_names=("set 1",), broadcast_rows=0)
    assert re.search(r"PartitionFilters: \[[^\n]*>= date_add\(Subquery", plan_of(curve))
    bounds = curve._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"pull_date#\d+ >= date_add\(scalar-subquery", bounds)
    assert re.search(r"pull_date#\d+ <= date_add\(scalar-subquery", bounds)


def test_sql_search_filters_prices_before_aggregating(spark, tables):
    prices, items = tables
    prices.createOrReplaceTempView("plan_prices")
    items.createOrReplaceTempView("plan_items")
    register_item_search(spark, "plan_prices", "plan_items", "plan_search")
    with settings(spark, NO_BROADCAST):
        text = plan_of(spark.sql("SELECT * FROM plan_search('name 1', 'set')"))
    assert text.index("partial_count(1)") < text.index("LeftSemi")


def test_views_run_nothing_when_registered(spark, tables):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    launch_views(*tables)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_days_are_utc_in_any_session(spark):
    with settings(spark, {"spark.sql.session.timeZone": "Pacific/Auckland"}):
        configure(spark)
        log = spark.sql("SELECT TIMESTAMP '2024-01-01 23:30:00Z' AS start_time, 'w' AS warehouse_name, 1.0BD AS credits_used")
        assert [str(r["day"]) for r in cost_daily(log).collect()] == ["2024-01-01"]


def test_upsert_shuffles_each_side_once(tables):
    _, items = tables
    dated = items.withColumn("pull_date", F.lit(AS_OF))
    text = plan_of(classified_upsert(dated, dated))
    assert "FullOuter" in text and hash_shuffles(text) == 2


def test_copies_are_dropped_before_the_shuffle(tables):
    prices, _ = tables
    text = plan_of(one_per_key(prices, ("id",), F.desc("pull_date")))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")
