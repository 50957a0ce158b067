"""The library's inputs, derived from the driver's tables.

Every frame covers its whole table.  Frames that need files write them once per session and
data directory, below the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql import types as T

from pricetrail.operators.conform import conform
from pricetrail.schemas import FACE_FIELDS, IMAGE_SIZES, ITEM_FLAGS, ITEM_LISTS, LANDING_ITEMS, LEGALITY_FORMATS, PRICES
from pricetrail.plans.loads import load_prices
from pricetrail.plans.maintained import ItemStats, LaunchState, Maintained
from pricetrail.session import scratch_dir
from pricetrail.sources.landing import append_prices, day_path, price_stage, write_day, write_days

AS_OF = date(2024, 1, 30)
USAGE_AS_OF = date(2024, 2, 10)
SNAPSHOT_DAY = date(2024, 1, 8)
CENTS = "decimal(10,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare with any client's number type."""
    return df.select(
        [
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def released(first: str, days_per_size: int) -> Column:
    return F.date_add(F.lit(date.fromisoformat(first)), F.col("p_size") * days_per_size)


def rarity() -> Column:
    step = F.col("p_size") % 4
    return F.when(step == 0, "mythic").when(step == 1, "rare").when(step == 2, "uncommon").otherwise("common")


# --- daily prices of the last month, and their items --------------------------------------


def prices_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    daily = events.groupBy(F.col("user_id").alias("id"), F.col("ts").cast("date").alias("pull_date"))
    return daily.agg(F.max("value").cast(CENTS).alias("usd"))


def items_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").alias("tcgplayer_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("set_name"),
        F.col("p_type").alias("set_type"),
        released("2010-01-01", 100).alias("released_at"),
    )


# --- prices around release dates ----------------------------------------------------------


def line_prices(lines: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice")
    foil = price.cast(CENTS) * (1 - F.col("l_discount").cast("decimal(4,2)"))
    daily = lines.groupBy(F.col("l_partkey").alias("id"), F.col("l_shipdate").cast("date").alias("pull_date"))
    return daily.agg(
        F.min(price).cast("decimal(8,2)").alias("usd"),
        F.min(F.when(F.col("l_discount") > 0.03, foil)).cast("decimal(8,2)").alias("usd_foil"),
    )


def prices_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_prices(table(spark, sf_dir, "lineitem"))


def items_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts; every eleventh has an id that no price has, so both sides have rows alone."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.when(key % 11 == 5, -key).otherwise(key).alias("id"),
        F.col("p_partkey").alias("tcgplayer_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("set_name"),
        F.col("p_type").alias("set_type"),
        released("1998-01-01", 20).alias("released_at"),
        rarity().alias("rarity"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup that knows the promotional items."""
    promo = table(spark, sf_dir, "part").filter(F.col("p_type") == "PROMO")
    return promo.select(F.col("p_partkey").alias("id"), (F.col("p_size") % 16 + 1).alias("game"))


# --- logs ---------------------------------------------------------------------------------


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("start_time"),
        F.col("event_type").alias("warehouse_name"),
        F.col("value").cast("decimal(12,4)").alias("credits_used"),
    )


def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger with one file per order."""
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "O", "prices").otherwise("items").alias("table_name"),
        F.concat(F.lit("part-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("file_name"),
        F.round(F.col("o_totalprice").cast("decimal(12,2)") / 100000, 2).cast("double").alias("file_mb"),
        F.col("o_orderdate").alias("load_time"),
    )


# --- merges -------------------------------------------------------------------------------


def loaded_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the target holds before the merge: prices of the lines already closed."""
    return line_prices(table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "F"))


def arriving_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prices, one unit higher, so that a wrong update would show."""
    return prices_l(spark, sf_dir).withColumn("usd", (F.col("usd") + 1).cast(CENTS))


def known_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item table before the merge: all but the promotional items."""
    parts = table(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO")
    return _item_version(parts, F.col("p_name"), F.lit(date(2024, 1, 1)))


def arriving_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items renamed; dates later, equal, earlier and missing."""
    given = F.when(F.col("p_size") != 50, released("2023-12-07", 1))
    return _item_version(table(spark, sf_dir, "part"), F.upper("p_name"), given)


def _item_version(parts: DataFrame, name: Column, pull_date: Column) -> DataFrame:
    return parts.select(
        F.col("p_partkey").alias("id"),
        name.alias("name"),
        F.col("p_brand").alias("set_name"),
        F.col("p_type").alias("set_type"),
        pull_date.alias("pull_date"),
    )


# --- files --------------------------------------------------------------------------------

ROWS_PER_TASK = 25_000  # of records that are some kilobytes of JSON each

_written: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], object]) -> str:
    """Path of a scratch dataset, written on first use in this session."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = scratch_dir(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def dealt(rows: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Short rows of which long ones are made, dealt over tasks by their number; Spark would read many of them in one task."""
    tasks = -(-rows.count() // (rows_per_task or ROWS_PER_TASK))
    return rows.repartition(tasks) if tasks > 1 else rows


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested snapshot records, with missing and malformed prices."""
    size, key = F.col("p_size"), F.col("p_partkey")
    text_id = key.cast("string")
    listed = F.col("p_retailprice").cast(CENTS)

    def marked(name: str) -> Column:
        """Text that tells its own field."""
        return F.concat(F.lit(f"{name} "), text_id)

    def listed_text(name: str) -> Column:
        """0 to 2 elements."""
        return F.slice(F.array(F.lit(f"{name}1"), F.lit(f"{name}2")), 1, size % 3)

    def face(side: str) -> Column:
        return F.struct(*[marked(f"{side} {field}").alias(field) for field in FACE_FIELDS])

    faces = F.array(face("front"), face("back"))
    texts = (
        "layout", "mana_cost", "type_line", "oracle_text", "power", "toughness", "image_status", "artist",
        "illustration_id", "border_color", "frame", "security_stamp", "watermark", "card_back_id",
    )
    return dealt(table(spark, sf_dir, "part")).select(
        text_id.alias("id"),
        F.concat(F.lit("o"), text_id).alias("oracle_id"),
        (key * 2).alias("mtgo_id"),
        F.when(size % 5 != 0, key * 2 + 1).alias("mtgo_foil_id"),
        key.alias("tcgplayer_id"),
        (key + 7).alias("cardmarket_id"),
        F.col("p_name").alias("name"),
        F.lit("en").alias("lang"),
        released("2010-01-01", 100).cast("string").alias("released_at"),
        F.col("p_brand").alias("set_name"),
        F.lower("p_brand").alias("set"),
        F.col("p_type").alias("set_type"),
        rarity().alias("rarity"),
        F.struct(
            F.when(size % 10 == 0, F.lit(None).cast("string"))
            .when(size % 10 == 1, F.lit("n/a"))
            .otherwise(listed.cast("string"))
            .alias("usd"),
            F.when(~(size % 10).isin(0, 3), (listed + size).cast(CENTS).cast("string")).alias("usd_foil"),
        ).alias("prices"),
        F.lit("card").alias("object"),
        F.concat(F.lit("s"), F.lower("p_brand")).alias("set_id"),
        text_id.alias("collector_number"),
        (size / 2).alias("cmc"),
        *[marked(name).alias(name) for name in texts],
        size.alias("edhrec_rank"),
        F.array(key, key + 1).alias("multiverse_ids"),
        *[listed_text(name).alias(name) for name in ITEM_LISTS if name != "multiverse_ids"],
        *[(size % n == 0).alias(name) for n, name in enumerate(("highres_image", *ITEM_FLAGS), start=2)],
        F.struct(*[
            F.when(size % n == 0, "legal").otherwise("not_legal").alias(name)
            for n, name in enumerate(LEGALITY_FORMATS, start=2)
        ]).alias("legalities"),
        F.struct(*[marked(f"img/{name}").alias(name) for name in IMAGE_SIZES]).alias("image_uris"),
        F.struct(
            F.lit("2009-12-24").alias("previewed_at"), marked("uri").alias("source_uri"), marked("source").alias("source")
        ).alias("preview"),
        F.struct(F.concat(F.lit("buy/"), text_id).alias("tcgplayer")).alias("purchase_uris"),
        F.when(size % 3 != 0, F.slice(faces, 1, size % 3)).alias("card_faces"),
    )


def snapshot_lines(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "snapshot_lines", lambda path: raw_items(spark, sf_dir).write.json(path))


def write_arrays(records: DataFrame, path: str, size: int = 10_000) -> None:
    """One complete JSON array per range of ``size`` ids, each a file of its own with one element per line."""
    n = F.col("id").cast("long")
    elements = records.select(n.alias("n"), F.floor(n / size).alias("range"), F.to_json(F.struct("*")).alias("element"))
    own = Window.partitionBy("range")
    opening = F.when(F.col("n") == F.min("n").over(own), "[\n").otherwise("")
    closing = F.when(F.col("n") == F.max("n").over(own), "\n]").otherwise(",")
    lines = elements.select("range", "n", F.concat(opening, "element", closing).alias("value"))
    lines = lines.sortWithinPartitions("range", "n").select("range", "value")
    lines.write.partitionBy("range").text(path)


def snapshot_array(spark: SparkSession, sf_dir: str) -> str:
    """The same records as JSON arrays with one element per line, one file per range of ids."""
    return once(spark, sf_dir, "snapshot_array", lambda path: write_arrays(raw_items(spark, sf_dir), path))


def landing_rows(spark: SparkSession, sf_dir: str, prices: DataFrame | None = None) -> DataFrame:
    """Prices in landing types; the foil price is twice the regular one."""
    prices = prices_m(spark, sf_dir) if prices is None else prices
    return prices.select(
        F.col("id").cast("string").alias("id"),
        F.col("usd").cast("double").alias("usd"),
        (F.col("usd") * 2).cast("double").alias("usd_foil"),
        F.col("pull_date").cast("string").alias("pull_date"),
    )


def items_month(spark: SparkSession, sf_dir: str, early: bool = False) -> DataFrame:
    """Items released around the month; the early table lacks some and has other release dates of some."""
    size = F.col("p_size")
    late = F.when(size % 7 == 3, 30).otherwise(0) if early else F.lit(0)
    parts = table(spark, sf_dir, "part")
    return (parts.filter(size % 5 != 0) if early else parts).select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_partkey").alias("tcgplayer_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("set_name"),
        F.col("p_type").alias("set_type"),
        F.date_add(F.lit(date(2023, 10, 1)), size * 2 + late).alias("released_at"),
        rarity().alias("rarity"),
    )


def maintained_month(spark: SparkSession, sf_dir: str) -> str:
    """The month's prices in three arrivals, each followed by item statistics and launch sums; items change before the last."""

    def write(base):
        stats, launch = ItemStats(spark, f"{base}/stats"), LaunchState(spark, f"{base}/launch")
        maintained = Maintained(spark, f"{base}/prices", f"{base}/maintained", stats, launch)
        maintained.update_items(items_month(spark, sf_dir, early=True))
        rows = landing_rows(spark, sf_dir)
        for turn in range(3):
            stage = price_stage(f"{base}/landing-{turn}")
            write_days(rows.filter(F.dayofmonth(F.col("pull_date").cast("date")) % 3 == turn), stage.path)
            if turn == 2:
                maintained.update_items(items_month(spark, sf_dir))
            load_prices(
                spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 2, 1 + turn), maintained=maintained
            )

    return once(spark, sf_dir, "maintained", write)


def landing_prices(spark: SparkSession, sf_dir: str) -> str:
    return once(
        spark, sf_dir, "landing_prices", lambda path: write_days(landing_rows(spark, sf_dir), path)
    )


def landing_item_rows(spark: SparkSession, sf_dir: str, pull_date: date) -> DataFrame:
    """Items in landing types as of one day."""
    raw = raw_items(spark, sf_dir).withColumn("pull_date", F.lit(pull_date.isoformat()))
    return raw.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in LANDING_ITEMS])


def landing_items(spark: SparkSession, sf_dir: str) -> str:
    """Item snapshots on the Mondays of the month."""

    def write(path):
        for day in (1, 8, 15, 22, 29):
            monday = date(2024, 1, day)
            write_day(landing_item_rows(spark, sf_dir, monday), path, monday)

    return once(spark, sf_dir, "landing_items", write)


def item_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item snapshots of three dates, partitioned by date."""

    def write(path):
        parts = table(spark, sf_dir, "part")
        dated = F.date_add(F.lit(date(2024, 1, 1)), F.col("p_size") % 3 * 7)
        rows = _item_version(parts, F.col("p_name"), dated)
        rows.hint("rebalance", "pull_date").write.partitionBy("pull_date").parquet(path)

    path = once(spark, sf_dir, "item_snapshots", write)
    schema = "id BIGINT, name STRING, set_name STRING, set_type STRING, pull_date DATE"
    return spark.read.schema(schema).parquet(path)


def loaded_month(spark: SparkSession, sf_dir: str) -> str:
    """The view prices of the month as a curated fact, partitioned by date."""

    def write(path):
        events = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
        views = events.groupBy(F.col("user_id").alias("id"), F.col("ts").cast("date").alias("pull_date"))
        views = views.agg(F.max("value").cast(CENTS).alias("usd"))
        append_prices(conform(landing_rows(spark, sf_dir, views), PRICES), path)

    return once(spark, sf_dir, "loaded_month", write)


def daily_snapshot(spark: SparkSession, sf_dir: str, day: date, base: str) -> str:
    """The snapshot of one day, with that day's prices."""
    today = prices_m(spark, sf_dir).filter(F.col("pull_date") == F.lit(day))
    quoted = today.select(F.col("id").cast("string").alias("id"), F.col("usd").cast("string").alias("usd"))
    raw = raw_items(spark, sf_dir).drop("prices").join(quoted, "id", "left")
    path = day_path(base, day)
    raw.withColumn("prices", F.struct("usd", F.lit(None).cast("string").alias("usd_foil"))).write.json(path)
    return path
