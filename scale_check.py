"""Time the operators on about 30 million price rows: python scale_check.py [hot]

80,000 items (the 20,000 parts of sf0.1, four of each) times 370 days, written once by day
and once by item.  With ``hot``, one item holds a third of all rows, as copies.  Everything
goes to a new scratch folder; nothing is deleted.
"""

from __future__ import annotations

import sys
import time
from datetime import date

from pyspark.sql import functions as F

from pricetrail import local_session, scratch_dir
from pricetrail.operators.curves import launch_curve
from pricetrail.operators.lookup import item_history, search_items
from pricetrail.operators.merge import classified_upsert, new_price_rows
from pricetrail.operators.movers import lookback_slice, price_movers, top_movers
from pricetrail.schemas import PRICES
from pricetrail.sources.landing import append_prices, write_by_id

SF = "/root/testdata/sf0.1"
AS_OF = date(2024, 12, 31)
DAYS, COPIES = 370, 4


def timed(label, action):
    started = time.perf_counter()
    result = action()
    print(f"{label:34} {time.perf_counter() - started:7.2f}s  {'' if result is None else result}", flush=True)


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def main(*options):
    spark = local_session(8, 32, **{"spark.driver.memory": "20g"})
    base = scratch_dir(spark, "scale")
    part = spark.read.parquet(f"{SF}/part.parquet").repartition(32)
    copied = part.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    key = (F.col("p_partkey") * COPIES + F.col("copy")).cast("string")
    items = copied.select(
        key.alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("set_name"),
        F.col("p_type").alias("set_type"),
        F.date_add(F.lit(date(2023, 1, 1)), F.col("p_size") * 20).alias("released_at"),
        F.lit("rare").alias("rarity"),
        F.col("p_partkey").cast("decimal(10,0)").alias("tcgplayer_id"),
        F.lit(AS_OF).alias("pull_date"),
    )
    items.write.parquet(f"{base}/items")
    items = spark.read.parquet(f"{base}/items")
    dated = copied.withColumn("ago", F.explode(F.sequence(F.lit(0), F.lit(DAYS - 1))))
    move = F.pmod(F.xxhash64("p_partkey", "copy", "ago"), F.lit(1000))
    item_id = F.when(move % 3 == 0, F.lit("7")).otherwise(key) if "hot" in options else key
    rows = dated.select(
        item_id.alias("id"),
        (F.col("p_retailprice") * (move + 500) / 100000).cast("decimal(10,2)").alias("usd"),
        F.when(move % 2 == 0, (move / 10).cast("decimal(10,2)")).alias("usd_foil"),
        F.date_sub(F.lit(AS_OF), F.col("ago")).alias("pull_date"),
    )
    timed("write by day", lambda: append_prices(rows, f"{base}/prices"))
    prices = spark.read.schema(PRICES).parquet(f"{base}/prices")
    timed("write by item", lambda: write_by_id(prices, f"{base}/by_id"))
    by_id = spark.read.parquet(f"{base}/by_id")

    curve = {"set_types": ("PROMO",), "released_from": date(2023, 6, 1)}
    for turn in ("cold", "warm"):
        print(turn)
        timed("lookback_slice", lambda: drain(lookback_slice(prices, items, AS_OF)))
        timed("price_movers", lambda: drain(price_movers(prices, items, AS_OF)))
        timed("top_movers", lambda: drain(top_movers(price_movers(prices, items, AS_OF))))
        timed("launch_curve, one type", lambda: drain(launch_curve(prices, items, **curve)))
        timed("launch_curve, all items", lambda: drain(
            launch_curve(prices, items, set_types=None, released_from=None)))
        timed("search_items, 'red' in 'brand#1'", lambda: drain(search_items(prices, items, "red", "brand#1")))
        timed("item_history, by day", lambda: drain(item_history(prices, items, "7")))
        timed("item_history, by item", lambda: drain(item_history(by_id, items, "7")))
        arriving = prices.filter(F.col("pull_date") == AS_OF).withColumn("usd", F.col("usd") + 1)
        arriving = arriving.withColumn("usd", F.col("usd").cast("decimal(10,2)"))
        timed("merge of one day", lambda: new_price_rows(prices, arriving, keyless=False).count())
        timed("newer-wins merge of all items", lambda: drain(classified_upsert(items, items)))

    off = "spark.sql.autoBroadcastJoinThreshold"
    for key_ in (off, "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key_, "-1")
    print("without broadcast")
    curve["broadcast_rows"] = 0
    timed("launch_curve, one type", lambda: drain(launch_curve(prices, items, **curve)))
    curve |= {"set_types": None, "released_from": None}
    timed("launch_curve, all items", lambda: drain(launch_curve(prices, items, **curve)))
    timed("price_movers", lambda: drain(price_movers(prices, items, AS_OF)))
    timed("search_items, all", lambda: drain(search_items(prices, items)))


if __name__ == "__main__":
    main(*sys.argv[1:])
