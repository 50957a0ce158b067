"""Query name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetrail.functions.columns import file_name, megabytes
from pricetrail.functions.table_functions import register_item_prices, register_item_search
from pricetrail.operators import checks, curves, flatten, lookup, merge, movers, usage
from pricetrail.operators.conform import BAD_COLUMNS, conform, conform_checked
from pricetrail.plans import loads, replay, wide
from pricetrail.plans.daily import Lake, land_snapshot, run_day
from pricetrail.plans.maintained import ItemStats, LaunchState
from pricetrail.plans.views import LAUNCH_VIEWS
from pricetrail.schemas import ITEM_RENAMES, ITEMS, MOVER_SLICE, PRICES, RAW_WIDE
from pricetrail.session import scratch_dir
from pricetrail.sources import compaction, landing, ledger, snapshots, versions
from pricetrail.sources.by_id import CopyById
from pricetrail.sources.name_index import NameIndex
from pricetrail.streaming import ingest
from workload import frames
from workload.frames import AS_OF, SNAPSHOT_DAY, USAGE_AS_OF, plain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The launch curves on these tables: which type plays the expansion, and since when.
EXPANSION = ("PROMO",)
SINCE = date(1998, 6, 1)
MONTH_SINCE = date(2023, 10, 15)
FIVE_SETS = ("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5")
ITEM_ID = 7
LEDGER_SINCE = date(1998, 8, 1)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- movers -------------------------------------------------------------------------------


def _movers(spark, sf):
    return movers.price_movers(frames.prices_m(spark, sf), frames.items_m(spark, sf), AS_OF)


@query
def lookback_slice(spark, sf):
    return plain(movers.lookback_slice(frames.prices_m(spark, sf), frames.items_m(spark, sf), AS_OF))


@query
def price_movers(spark, sf):
    return plain(_movers(spark, sf))


def _slice_file(spark, sf):
    """The lookback slice as the CSV files that hand it to the next step."""
    path = scratch_dir(spark, "slice")
    rows = movers.lookback_slice(frames.prices_m(spark, sf), frames.items_m(spark, sf), AS_OF)
    landing.publish_csv(rows, path)
    return landing.read_csv(spark, path, MOVER_SLICE)


@query
def movers_from_slice(spark, sf):
    return plain(movers.movers_from_slice(_slice_file(spark, sf), AS_OF))


@query
def top_movers(spark, sf):
    return plain(movers.top_movers(_movers(spark, sf), 10))


@query
def top_movers_week(spark, sf):
    return plain(movers.top_movers(_movers(spark, sf), 3, by="1wk_diff"))


# --- launch curves ------------------------------------------------------------------------


def _curve(spark, sf, **arguments):
    settings = {"set_types": EXPANSION, "released_from": SINCE, **arguments}
    return plain(curves.launch_curve(frames.prices_l(spark, sf), frames.items_l(spark, sf), **settings))


@query
def launch_after(spark, sf):
    return _curve(spark, sf)


@query
def launch_after_foil(spark, sf):
    return _curve(spark, sf, price="usd_foil")


@query
def launch_after_rare(spark, sf):
    return _curve(spark, sf, rarities=curves.SCARCE)


@query
def launch_after_foil_rare(spark, sf):
    return _curve(spark, sf, price="usd_foil", rarities=curves.SCARCE)


@query
def launch_variable(spark, sf):
    return _curve(spark, sf, set_names=FIVE_SETS, by_rarity=True, released_from=None)


@query
def launch_before(spark, sf):
    return _curve(spark, sf, days=curves.BEFORE)


@query
def launch_before_foil(spark, sf):
    return _curve(spark, sf, price="usd_foil", days=curves.BEFORE)


@query
def launch_from_state(spark, sf):
    """All seven curves of the month's prices from kept sums."""
    state = LaunchState(spark, f"{frames.maintained_month(spark, sf)}/launch").state()
    settings = {"set_types": EXPANSION, "released_from": MONTH_SINCE}
    found = None
    for name, own in LAUNCH_VIEWS.items():
        named = {"set_names": FIVE_SETS} if "set_names" in own else {}
        curve = curves.curve_from_state(state, **{**settings, **own, **named})
        rarity = F.col("rarity") if own.get("by_rarity") else F.lit(None).cast("string")
        curve = curve.select(F.lit(name).alias("view"), "date_diff", "avg_usd", "set_name", rarity.alias("rarity"))
        found = curve if found is None else found.unionByName(curve)
    return found


# --- usage and ledger ---------------------------------------------------------------------


@query
def usage_recent(spark, sf):
    return plain(usage.usage_recent(frames.usage(spark, sf)))


@query
def cost_by_day_resource(spark, sf):
    return plain(usage.cost_by_day_resource(frames.usage(spark, sf)))


@query
def cost_by_resource(spark, sf):
    return plain(usage.cost_by_resource(frames.usage(spark, sf)))


@query
def cost_daily(spark, sf):
    return plain(usage.cost_daily(frames.usage(spark, sf)))


@query
def cost_rollup_30d(spark, sf):
    return plain(usage.cost_rollup(frames.usage(spark, sf), USAGE_AS_OF))


@query
def ledger_history(spark, sf):
    return ledger.ledger_history(frames.file_ledger(spark, sf))


@query
def ledger_recent(spark, sf):
    since = F.date_sub(F.lit(LEDGER_SINCE), 7)
    return ledger.ledger_recent(frames.file_ledger(spark, sf), "prices", since)


# --- lookups ------------------------------------------------------------------------------


@query
def item_history(spark, sf):
    return plain(lookup.item_history(frames.prices_l(spark, sf), frames.items_l(spark, sf), ITEM_ID))


@query
def search_items(spark, sf):
    return plain(
        lookup.search_items(frames.prices_l(spark, sf), frames.items_l(spark, sf), "red", "brand#1")
    )


@query
def search_items_any(spark, sf):
    return plain(lookup.search_items(frames.prices_l(spark, sf), frames.items_l(spark, sf), None, ""))


@query
def search_indexed(spark, sf):
    """``search_items`` by an index of three-letter runs, made of all but the promotional items first."""
    items = frames.items_l(spark, sf)
    index = NameIndex(spark, scratch_dir(spark, "names"), items.schema["id"].dataType)
    for known in (items.filter(F.col("set_type") != "PROMO"), items):
        index.update(known)
    return plain(index.search(frames.prices_l(spark, sf), items, "red", "brand#1"))


@query
def search_from_state(spark, sf):
    """Every item of the month with its kept statistics."""
    stats = ItemStats(spark, f"{frames.maintained_month(spark, sf)}/stats").current()
    return plain(lookup.search_stats(stats, frames.items_month(spark, sf)))


@query
def lookup_join(spark, sf):
    return plain(lookup.lookup_join(frames.prices_l(spark, sf), frames.games(spark, sf)))


def _lookup_views(spark, sf):
    frames.prices_l(spark, sf).createOrReplaceTempView("item_prices")
    frames.items_l(spark, sf).createOrReplaceTempView("items")


@query
def table_fn_history(spark, sf):
    _lookup_views(spark, sf)
    register_item_prices(spark, "item_prices", "items", id_type="BIGINT")
    return plain(spark.sql(f"SELECT * FROM get_card_prices({ITEM_ID})"))


@query
def table_fn_search(spark, sf):
    _lookup_views(spark, sf)
    register_item_search(spark, "item_prices", "items", id_type="BIGINT")
    return plain(spark.sql("SELECT * FROM get_card_id('red', 'brand#1')"))


# --- snapshot flattening and loading ------------------------------------------------------


def _raw(spark, sf):
    return snapshots.read_snapshot(spark, frames.snapshot_lines(spark, sf))


@query
def json_flatten(spark, sf):
    return flatten.quoted_prices(_raw(spark, sf))


@query
def json_array_lines(spark, sf):
    path = frames.snapshot_array(spark, sf)
    return flatten.quoted_prices(snapshots.read_snapshot(spark, path, layout="array_lines"))


@query
def daily_prices(spark, sf):
    return flatten.daily_prices(_raw(spark, sf), SNAPSHOT_DAY)


@query
def static_fields(spark, sf):
    return flatten.static_fields(_raw(spark, sf), SNAPSHOT_DAY)


@query
def flatten_wide(spark, sf):
    raw = snapshots.read_snapshot(spark, frames.snapshot_lines(spark, sf), RAW_WIDE)
    return flatten.flatten_wide(raw, SNAPSHOT_DAY)


@query
def load_wide(spark, sf):
    """A first snapshot without promotional items, then one without every fourth size, with a new field and wider ranks."""
    base = scratch_dir(spark, "wide")
    raw, rank = frames.raw_items(spark, sf), F.col("edhrec_rank")
    first = raw.filter(F.col("set_type") != "PROMO")
    second = raw.filter(rank % 4 != 1).withColumn("release_note", F.concat(F.lit("note "), "id"))
    second = second.withColumn("edhrec_rank", rank + F.lit(3_000_000_000))
    table = wide.wide_table(spark, f"{base}/table", rows_per_group=500)
    for day, records in ((SNAPSHOT_DAY - timedelta(days=7), first), (SNAPSHOT_DAY, second)):
        records.write.json(f"{base}/{day}")
        wide.load_wide(spark, f"{base}/{day}", table, day)
    return table.current()


@query
def conform_by_name(spark, sf):
    items = frames.landing_item_rows(spark, sf, SNAPSHOT_DAY)
    shuffled = items.select(
        F.col("set_type").alias("Set_Type"),
        F.col("id").alias("ID"),
        F.col("`set`").alias("SET"),
        F.col("tcgplayer_id").alias("TCGplayer_ID"),
        F.col("released_at").alias("RELEASED_AT"),
        F.col("mtgo_id").alias("unknown"),
        F.col("pull_date").alias("Pull_Date"),
    )
    return plain(conform(shuffled, ITEMS, ITEM_RENAMES))


@query
def reject_split(spark, sf):
    quoted = flatten.quoted_prices(_raw(spark, sf)).withColumn("pull_date", F.lit(SNAPSHOT_DAY.isoformat()))
    checked = conform_checked(quoted, PRICES)
    return plain(checked.withColumn(BAD_COLUMNS, F.array_join(BAD_COLUMNS, ",")))


@query
def job_counts(spark, sf):
    lake = Lake(scratch_dir(spark, "lake"))
    raw = _raw(spark, sf).persist()
    try:
        return land_snapshot(spark, raw, lake, SNAPSHOT_DAY)
    finally:
        raw.unpersist()


# --- merges -------------------------------------------------------------------------------


@query
def merge_insert_only(spark, sf):
    target, source = frames.loaded_prices(spark, sf), frames.arriving_prices(spark, sf)
    # The target here is derived, not partitioned by date: there are no files to prune.
    return plain(merge.merge_insert_only(target, source, prune=False))


@query
def merge_pruned(spark, sf):
    """What all prices of the first day and the second half would add to the loaded view prices."""
    target = landing.open_prices(spark, frames.loaded_month(spark, sf))
    rows = frames.landing_rows(spark, sf)
    rows = rows.filter((F.col("pull_date") == "2024-01-01") | (F.col("pull_date") >= "2024-01-16"))
    return plain(merge.new_price_rows(target, conform(rows, PRICES), keyless=False))


@query
def upsert_newer_wins(spark, sf):
    return merge.upsert_newer_wins(frames.known_items(spark, sf), frames.arriving_items(spark, sf))


@query
def upsert_outcome(spark, sf):
    return merge.upsert_outcome(frames.known_items(spark, sf), frames.arriving_items(spark, sf))


@query
def latest_snapshot(spark, sf):
    return landing.latest_snapshot(frames.item_snapshots(spark, sf), F.lit(date(2024, 1, 12)))


# --- files --------------------------------------------------------------------------------


@query
def partition_roundtrip(spark, sf):
    return landing.price_stage(frames.landing_prices(spark, sf)).read(spark)


@query
def partition_slice(spark, sf):
    stage = landing.price_stage(frames.landing_prices(spark, sf))
    day = (F.col("year") == "2024") & (F.col("month") == "01") & (F.col("day") == "08")
    typed = conform(stage.read(spark).filter(day), PRICES)
    return plain(typed)


@query
def day_count(spark, sf):
    return checks.day_count(frames.prices_m(spark, sf), date(2024, 1, 16))


@query
def partition_files(spark, sf):
    """Listed files against the rows that reading them gives, by dataset and day."""
    stages = _stages(spark, sf)
    files = checks.partition_files(spark, stages)
    counts = None
    for dataset, stage in stages.items():
        day = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
        rows = stage.read(spark).select(F.lit(dataset).alias("dataset"), day.alias("pull_date"), "_metadata.file_name")
        rows = rows.groupBy("dataset", "pull_date", "file_name").agg(F.count("*").alias("n"))
        counts = rows if counts is None else counts.unionByName(rows)
    found = files.join(counts, ["dataset", "pull_date", "file_name"], "left")
    return found.groupBy("dataset", "pull_date").agg(
        F.sum("n").alias("row_count"), F.every(F.col("n").isNotNull() & (F.col("length") > 0)).alias("all_read")
    )


@query
def file_columns(spark, sf):
    """File name and size columns, of paths and sizes made from the orders."""
    paths = frames.table(spark, sf, "orders").select(
        F.concat_ws("/", F.lit("s3://b"), "o_orderstatus", F.concat(F.lit("part-"), F.col("o_orderkey"))).alias("path"),
        (F.col("o_totalprice") * 1000).cast("bigint").alias("length"),
    )
    return paths.select(file_name(F.col("path")).alias("file_name"), megabytes(F.col("length")).alias("size_mb"))


@query
def partition_missing(spark, sf):
    days = frames.table(spark, sf, "events").select(F.col("ts").cast("date").alias("pull_date")).distinct()
    datasets = F.explode(F.array(F.lit("items"), F.lit("prices"))).alias("dataset")
    expected = days.select(datasets, "pull_date")
    return checks.missing_days(checks.partition_files(spark, _stages(spark, sf)), expected)


def _stages(spark, sf):
    return {
        "prices": landing.price_stage(frames.landing_prices(spark, sf)),
        "items": landing.item_stage(frames.landing_items(spark, sf)),
    }


@query
def csv_publish(spark, sf):
    path = scratch_dir(spark, "report")
    report = _movers(spark, sf)
    landing.publish_csv(report, path, F.desc_nulls_last("4wk_diff"), F.col("id"))
    return plain(landing.read_csv(spark, path, report.schema))


@query
def csv_slice(spark, sf):
    return plain(_slice_file(spark, sf))


@query
def layout_by_id(spark, sf):
    path = frames.once(
        spark, sf, "prices_by_id", lambda p: landing.write_by_id(frames.prices_l(spark, sf), p)
    )
    by_id = spark.read.parquet(path)
    return plain(lookup.item_history(by_id, frames.items_l(spark, sf), ITEM_ID))


@query
def layout_levels(spark, sf):
    """All prices in twelve arrivals, kept by item in runs: the rows, and whether few runs hold them."""
    base = scratch_dir(spark, "levels")
    rows = conform(frames.prices_l(spark, sf), PRICES)
    rows.withColumn("arrival", F.month("pull_date")).hint("rebalance", "arrival").write.partitionBy("arrival").parquet(f"{base}/arrivals")
    copy = CopyById(spark, f"{base}/copy", fanout=3)
    for month in range(1, 13):
        copy.apply(spark.read.schema(PRICES).parquet(f"{base}/arrivals/arrival={month}"), f"month {month}")
    few = len(copy.newest().parts) <= 4
    return plain(copy.current().withColumn("few_runs", F.lit(few)))


@query
def register_partition(spark, sf):
    """Two days of the landing files made visible in a catalog table, one of them twice."""
    stage = landing.price_stage(frames.landing_prices(spark, sf))
    name = "registered_" + stage.path.split("/")[-2].replace("-", "_")
    for day in (date(2024, 1, 8), date(2024, 1, 9), date(2024, 1, 9)):
        landing.register_day(spark, name, stage, day)
    return spark.table(name)


def _halves(spark, sf):
    """The month's prices as two arrivals."""
    rows = frames.landing_rows(spark, sf)
    first = F.col("pull_date") < "2024-01-16"
    return rows.filter(first), rows.filter(~first)


@query
def copy_new_files(spark, sf):
    """Rows inserted by a first load, a load after new files, and a load of nothing new."""
    base = scratch_dir(spark, "copy")
    stage = landing.price_stage(f"{base}/landing")
    reports = []
    for turn, rows in enumerate([*_halves(spark, sf), None], start=1):
        if rows is not None:
            landing.write_days(rows, stage.path)
        done = loads.load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 2, turn))
        reports.append(done.select(F.lit(turn).alias("turn"), "table_name", "rows_inserted", "rows_rejected"))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query
def replay_rejects(spark, sf):
    """Prices with a currency sign and without a price are rejected; a rule for the sign lets its rows through, twice applied."""
    base = scratch_dir(spark, "replay")
    stage = landing.price_stage(f"{base}/landing")
    signed, unpriced = F.col("id").cast("long") % 3 == 0, F.dayofmonth(F.col("pull_date").cast("date")) == 25
    usd = F.col("usd").cast("string")
    spelled = F.when(signed, F.concat(F.lit("$"), usd)).when(unpriced, "no price").otherwise(usd)
    landing.write_days(frames.landing_rows(spark, sf).withColumn("usd", spelled), stage.path)
    loads.load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 2, 1))
    for _ in range(2):
        replay.replay_rejects(spark, f"{base}/prices", {"usd": F.regexp_replace("usd", r"^\$", "")})
    rest = replay.outstanding_rejects(spark, f"{base}/prices/_rejects").select(PRICES.fieldNames())
    loaded = landing.open_prices(spark, f"{base}/prices").withColumn("state", F.lit("loaded"))
    return plain(loaded.unionByName(rest.withColumn("state", F.lit("rejected"))))


@query
def load_mixed_types(spark, sf):
    """Files with prices as doubles, decimals and text, and one that is no table, in one load."""
    base = scratch_dir(spark, "mixed")
    stage = landing.price_stage(f"{base}/landing")
    rows = frames.landing_rows(spark, sf)
    kinds = ("double", frames.CENTS, "string")
    for n, kind in enumerate(kinds):
        part = rows.filter(F.dayofmonth(F.col("pull_date").cast("date")) % len(kinds) == n)
        part.withColumns({c: F.col(c).cast(kind) for c in ("usd", "usd_foil")}).write.parquet(
            f"{stage.path}/kind={n}"
        )
    spark.range(1).select(F.lit("no table").alias("value")).write.text(f"{stage.path}/broken dir.parquet")
    loads.load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 2, 1))
    return plain(landing.open_prices(spark, f"{base}/prices"))


@query
def shared_table_load(spark, sf):
    """The month in three arrivals: loaded by a batch, by a stream, and by a batch, into one table."""
    base = scratch_dir(spark, "shared")
    rows = frames.landing_rows(spark, sf)
    for turn in range(3):
        stage = landing.price_stage(f"{base}/landing-{turn}")
        landing.write_days(rows.filter(F.dayofmonth(F.col("pull_date").cast("date")) % 3 == turn), stage.path)
        if turn == 1:
            ingest.merge_stream(spark, stage, f"{base}/prices", f"{base}/checkpoint").awaitTermination()
        else:
            loads.load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 2, 1 + turn))
    return plain(landing.open_prices(spark, f"{base}/prices"))


@query
def compact_days(spark, sf):
    """The month in five arrivals, compacted, with a late sixth: its rows, and whether few files hold each day."""
    base = scratch_dir(spark, "compact")
    path = f"{base}/prices"
    rows = conform(frames.landing_rows(spark, sf), PRICES)
    arrival = F.pmod(F.xxhash64("id"), F.lit(6))
    for turn in range(5):
        landing.append_prices(rows.filter(arrival == turn), path)
    compaction.compact_days(spark, path)
    landing.append_prices(rows.filter(arrival == 5), path)
    files = compaction.data_files(spark, path).filter("live").groupBy("pull_date").agg(F.count("*").alias("n"))
    whole = landing.open_prices(spark, path).join(files, "pull_date")
    return plain(whole.select("id", "usd", "usd_foil", "pull_date", (F.col("n") <= 2).alias("few_files")))


@query
def stream_then_batch(spark, sf):
    """One ledger: a stream loads the first half, a batch finds nothing new there, then loads the rest, of which the stream finds nothing."""
    base = scratch_dir(spark, "ledgers")
    stage = landing.price_stage(f"{base}/landing")
    prices, entries = f"{base}/prices", f"{base}/ledger"
    reports = []

    def stream():
        ingest.merge_stream(spark, stage, prices, f"{base}/checkpoint", ledger_path=entries).awaitTermination()

    def batch(turn):
        done = loads.load_prices(spark, stage, prices, entries, datetime(2024, 2, turn))
        reports.append(done.select(F.lit(turn).alias("turn"), (F.col("files_loaded") > 0).alias("new_files"), "rows_inserted"))

    first, second = _halves(spark, sf)
    landing.write_days(first, stage.path)
    stream()
    batch(1)
    landing.write_days(second, stage.path)
    batch(2)
    before = ledger.read_ledger(spark, entries).count()
    stream()
    after = ledger.read_ledger(spark, entries)
    twice = after.groupBy("file_name").agg(F.count("*").alias("n")).filter("n > 1").count()
    total = landing.open_prices(spark, prices).count()
    reports.append(loads.one_row(spark, rows=total).select(
        F.lit(3).alias("turn"), F.lit(after.count() > before or twice > 0).alias("new_files"), F.col("rows").alias("rows_inserted")
    ))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def _reconciled(spark, sf):
    """The month without three days, loaded; then one day gets a file more, and another loses rows on the way."""
    base = scratch_dir(spark, "reconcile")
    stage, rows = landing.price_stage(f"{base}/landing"), frames.landing_rows(spark, sf)
    day = F.dayofmonth(F.col("pull_date").cast("date"))
    usd = F.when((day == 25) & (F.col("id").cast("long") % 2 == 0), F.lit("no price")).otherwise(F.col("usd").cast("string"))
    for n, part in enumerate((day == 25, ~day.isin(10, 11, 12, 20, 25))):
        given = rows.filter(part).withColumn("usd", usd) if n == 0 else rows.filter(part)
        landing.write_days(given, stage.path)
    landing.write_days(rows.filter((day == 20) & (F.col("id").cast("long") % 2 == 0)), stage.path)
    loads.load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 2, 1))
    late = rows.filter((day == 20) & (F.col("id").cast("long") % 2 == 1))
    late.write.mode("append").parquet(landing.day_path(stage.path, date(2024, 1, 20)))
    files = checks.partition_files(spark, {"prices": stage})
    landed = stage.reader(spark).option("mergeSchema", False).load(stage.path).select("pull_date")
    entries = ledger.read_ledger(spark, f"{base}/ledger")
    days = checks.calendar(spark, date(2024, 1, 1), date(2024, 1, 30))
    return checks.reconcile_days(days, files, entries, landed, landing.open_prices(spark, f"{base}/prices"))


@query
def reconcile_days(spark, sf):
    return _reconciled(spark, sf).select("pull_date", "landed_rows", "curated_rows", "state")


@query
def missing_ranges(spark, sf):
    return checks.day_ranges(_reconciled(spark, sf))


@query
def load_items(spark, sf):
    """Outcomes of loading a snapshot, an older one, and a newer one."""
    stage = landing.item_stage(frames.landing_items(spark, sf))
    items = versions.VersionedTable(spark, scratch_dir(spark, "items"), ITEMS)
    outcomes = [
        loads.load_items(spark, stage, items, date(2024, 1, day)).select(
            F.lit(turn).alias("turn"), "rows_inserted", "rows_updated", "rows_skipped", "rows_merged"
        )
        for turn, day in enumerate((8, 1, 15), start=1)
    ]
    return outcomes[0].unionByName(outcomes[1]).unionByName(outcomes[2])


# --- streams ------------------------------------------------------------------------------


@query
def stream_ingest(spark, sf):
    """Two arrivals, loaded by two runs of one query; a third run finds nothing."""
    base = scratch_dir(spark, "ingest")
    stage = landing.price_stage(f"{base}/landing")
    for rows in [*_halves(spark, sf), None]:
        if rows is not None:
            landing.write_days(rows, stage.path)
        ingest.append_stream(spark, stage, f"{base}/prices", f"{base}/checkpoint").awaitTermination()
    return plain(spark.read.schema(PRICES).parquet(f"{base}/prices"))


@query
def stream_merge(spark, sf):
    """View prices are loaded first; then all prices arrive, twice."""
    base = scratch_dir(spark, "merge")
    stage = landing.price_stage(f"{base}/landing")
    events = frames.table(spark, sf, "events").filter(F.col("event_type") == "view")
    views = events.groupBy(F.col("user_id").alias("id"), F.col("ts").cast("date").alias("pull_date"))
    early = views.agg(F.max("value").cast(frames.CENTS).alias("usd"))
    landing.append_prices(conform(frames.landing_rows(spark, sf, early), PRICES), f"{base}/prices")
    for _ in range(2):
        landing.write_days(frames.landing_rows(spark, sf), stage.path)
        ingest.merge_stream(spark, stage, f"{base}/prices", f"{base}/checkpoint").awaitTermination()
    return plain(spark.read.schema(PRICES).parquet(f"{base}/prices"))


@query
def stream_upsert(spark, sf):
    """A newer snapshot without promotional items, then an older one with them."""
    base = scratch_dir(spark, "upsert")
    stage = landing.item_stage(f"{base}/landing")
    items = versions.VersionedTable(spark, f"{base}/items", ITEMS)
    newer = frames.landing_item_rows(spark, sf, date(2024, 1, 8)).filter(F.col("set_type") != "PROMO")
    newer = newer.withColumn("name", F.upper("name"))
    older = frames.landing_item_rows(spark, sf, date(2024, 1, 1))
    for day, rows in ((date(2024, 1, 8), newer), (date(2024, 1, 1), older)):
        landing.write_day(rows, stage.path, day)
        ingest.upsert_stream(spark, stage, items, f"{base}/checkpoint").awaitTermination()
    return plain(items.current())


@query
def daily_run(spark, sf):
    """The earlier days of the month by one load, then the last day's snapshot through the whole daily run."""
    base = scratch_dir(spark, "daily")
    lake = Lake(f"{base}/lake")
    earlier = frames.landing_rows(spark, sf).filter(F.col("pull_date") < AS_OF.isoformat())
    landing.write_days(earlier, lake.landing_prices.path)
    loads.load_prices(spark, lake.landing_prices, lake.prices, lake.ledger, datetime(2024, 1, 30))
    run_day(spark, frames.daily_snapshot(spark, sf, AS_OF, f"{base}/snapshots"), lake, AS_OF)
    prices = landing.open_prices(spark, lake.prices)
    report = movers.price_movers(prices, lake.items(spark).current(), AS_OF)
    return plain(landing.read_csv(spark, lake.report(AS_OF), report.schema))
