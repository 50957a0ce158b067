from __future__ import annotations

import csv
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pricetrail.functions.columns import file_name, megabytes
from pricetrail.operators import checks
from pricetrail.operators.lookup import item_history
from pricetrail.plans import loads
from pricetrail.plans.daily import Lake, run_day
from pricetrail.plans.loads import load_items, load_prices
from pricetrail.schemas import ITEMS, LANDING_ITEMS, LANDING_PRICES, LEDGER, PRICES
from pricetrail.sources import landing, ledger, versions

D1, D2 = date(2024, 8, 1), date(2024, 8, 2)


def landed(spark, *values):
    return spark.createDataFrame(list(values), LANDING_PRICES)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def test_day_path():
    assert landing.day_path("s3://b/x/", D1) == "s3://b/x/year=2024/month=08/day=01"


def test_write_day_replaces_also_by_nothing(spark, base):
    stage = landing.price_stage(base)
    assert landing.write_day(landed(spark, ("a", 1.0, None, "2024-08-01")), base, D1, "none") == 1
    assert landing.write_day(landed(spark, ("b", 1.0, None, "2024-08-02")), base, D2) == 1
    assert stage.read(spark).count() == 2
    assert landing.write_day(landed(spark), base, D1) == 0
    assert [r["id"] for r in stage.read(spark).collect()] == ["b"]
    assert stage.read_day(spark, D2).columns == LANDING_PRICES.fieldNames()


def test_write_days_keeps_other_days_and_text_partitions(spark, base):
    stage = landing.price_stage(base)
    landing.write_days(landed(spark, ("a", 1.0, None, "2024-08-01"), ("a", 2.0, None, "2024-08-02")), base)
    assert landing.write_days(landed(spark, ("z", 9.0, None, "2024-08-02")), base) == 1
    got = rows(stage.read(spark).select("id", "year", "month", "day").orderBy("day"))
    assert got == [("a", "2024", "08", "01"), ("z", "2024", "08", "02")]


def test_register_day_twice(spark, base):
    stage = landing.price_stage(base)
    for day in (D1, D2):
        landing.write_day(landed(spark, ("a", 1.0, None, day.isoformat())), base, day)
    try:
        landing.register_day(spark, "registered", stage, D1)
        landing.register_day(spark, "registered", stage, D1)
        assert spark.table("registered").count() == 1
        landing.register_day(spark, "registered", stage, D2)
        assert spark.table("registered").filter("month = '08' AND day = '02'").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS registered")


def test_latest_snapshot(spark):
    df = spark.createDataFrame(
        [("a", D1), ("b", D1), ("a", D2), ("c", date(2024, 9, 1))], "id STRING, pull_date DATE"
    )
    assert rows(landing.latest_snapshot(df, F.lit(date(2024, 8, 20)))) == [("a", D2)]
    assert landing.latest_snapshot(df, F.lit(D1)).count() == 2
    assert landing.latest_snapshot(df, F.lit(date(2024, 1, 1))).count() == 0


def test_csv_report(spark, base):
    df = spark.createDataFrame([("b", 1.5, None), ("a", None, D1)], "id STRING, usd DOUBLE, on DATE")
    for _ in range(2):
        landing.publish_csv(df, f"{base}/report", F.col("id"))
    assert rows(landing.read_csv(spark, f"{base}/report", df.schema)) == [("a", None, D1), ("b", 1.5, None)]
    landing.publish_csv(df, f"{base}/report", F.col("id"), first=1)
    assert [p.suffix for p in Path(f"{base}/report").glob("part-*")] == [".csv"]
    assert [r[0] for r in spark.read.text(f"{base}/report").collect()] == ["id,usd,on", "a,,2024-08-01"]


def test_csv_is_what_other_readers_read(spark, base):
    names = ['"Ach! Hans, Run!"', " lead and trail ", "a, b", "two\nlines", 'quote " inside', "back\\slash", None]
    df = spark.createDataFrame([(n, name) for n, name in enumerate(names)], "n INT, name STRING")
    landing.publish_csv(df, f"{base}/report", F.col("n"), whole=True)
    (part,) = Path(f"{base}/report").glob("part-*.csv")
    with open(part, newline="") as lines:
        read = list(csv.reader(lines))
    assert read == [["n", "name"], *[[str(n), name or ""] for n, name in enumerate(names)]]
    assert rows(landing.read_csv(spark, f"{base}/report", df.schema, line_breaks=True)) == rows(df)


def test_text_that_looks_missing_stays_text(spark, base):
    df = spark.createDataFrame([("NA",), ("None",)], "name STRING")
    landing.publish_csv(df, f"{base}/report", F.col("name"))
    assert rows(landing.read_csv(spark, f"{base}/report", df.schema)) == [("NA",), ("None",)]


def test_layout_by_id(spark, base, prices, items):
    facts = prices(*[(f"i{n % 7}", "1.00", None, f"2024-01-{n % 28 + 1:02}") for n in range(100)])
    landing.write_by_id(facts, f"{base}/by_id")
    by_id = spark.read.parquet(f"{base}/by_id")
    known = items({"id": "i3"})
    assert rows(item_history(by_id, known, "i3")) == rows(item_history(facts, known, "i3"))


def test_load_new_files_once(spark, base):
    stage, loaded = landing.price_stage(f"{base}/in"), datetime(2024, 8, 3, 4, 30)

    def load():
        done = load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", loaded, rejects_path=f"{base}/bad")
        return tuple(done.select("files_loaded", "rows_inserted").first())

    landing.write_day(landed(spark, ("a", 1.0, None, "2024-08-01"), ("b", 2.0, None, None)), stage.path, D1)
    files, inserted = load()
    assert files >= 1 and inserted == 1
    assert spark.read.parquet(f"{base}/bad").first()["bad_columns"] == ["pull_date"]
    assert load() == (0, 0)
    landing.write_day(
        landed(spark, ("a", 7.0, None, "2024-08-01"), ("a", 8.0, None, "2024-08-02")), stage.path, D2
    )
    files, inserted = load()
    assert files >= 1 and inserted == 1
    table = landing.open_prices(spark, f"{base}/prices")
    assert sorted((r["pull_date"], float(r["usd"])) for r in table.collect()) == [(D1, 1.0), (D2, 8.0)]
    history = ledger.read_ledger(spark, f"{base}/ledger")
    assert history.schema == LEDGER
    assert ledger.ledger_recent(history, "prices", F.lit(date(2024, 8, 1))).count() == history.count()
    assert ledger.ledger_recent(history, "prices", F.lit(date(2024, 8, 9))).count() == 0
    assert ledger.ledger_recent(history, "items", F.lit(date(2024, 8, 1))).count() == 0
    names = [r["file_name"] for r in ledger.ledger_history(history).collect()]
    assert names == sorted(names, reverse=True)


def test_a_backlog_loads_in_turns(spark, base):
    stage = landing.price_stage(f"{base}/in")
    for n in (1, 2, 3):
        day = date(2024, 8, n)
        landing.write_day(landed(spark, ("a", float(n), None, day.isoformat())), stage.path, day)
    done = load_prices(
        spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 8, 4), max_files=2
    ).first()
    assert (done["files_loaded"], done["rows_inserted"]) == (3, 3)
    assert ledger.read_ledger(spark, f"{base}/ledger").count() == 3


def test_unreadable_files_do_not_stop_a_load(spark, base):
    stage = landing.price_stage(f"{base}/in")
    landing.write_day(landed(spark, ("a", 1.0, None, "2024-08-01")), stage.path, D1)
    with open(f"{landing.day_path(stage.path, D1)}/broken.parquet", "wb") as broken:
        broken.write(b"PAR1 this is not a table PAR1")
    landing.write_day(landed(spark, ("a", 2.0, None, "2024-08-02")), stage.path, D2)

    def load():
        done = load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 8, 3)).first()
        return done["files_loaded"], done["files_failed"], done["rows_inserted"]

    assert load() == (2, 1, 2)
    assert load() == (0, 1, 0)  # still pending, in case it was the reading that failed
    assert landing.open_prices(spark, f"{base}/prices").count() == 2
    with pytest.raises(Exception):
        stage.read(spark).collect()
    skipping = landing.Stage(stage.path, stage.schema, skip_unreadable=True)
    assert skipping.read(spark).count() == 2


def test_six_broken_files_cost_no_merge(spark, base, monkeypatch):
    stage = landing.price_stage(f"{base}/in")
    landing.write_day(landed(spark, ("a", 1.0, None, "2024-08-01"), (None, 1.0, None, None)), stage.path, D1)
    for n in range(6):
        Path(f"{landing.day_path(stage.path, D1)}/bad file {n}.parquet").write_bytes(b"PAR1 no table PAR1")
    merges = []
    merge = loads.merge_staged
    monkeypatch.setattr(loads, "merge_staged", lambda *args: merges.append(1) or merge(*args))
    done = load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 8, 3)).first()
    found = tuple(done[c] for c in ("files_failed", "rows_inserted", "rows_rejected"))
    assert found == (6, 1, 1) and len(merges) == 1 and "1 rejected" in done["message"]
    aside = spark.read.parquet(f"{base}/prices/_rejects/load=20240803T000000/from=0").first()
    assert (float(aside["usd"]), aside["bad_columns"]) == (1.0, ["id", "pull_date"])


def test_files_of_other_types_load_by_row(spark, base):
    stage = landing.price_stage(f"{base}/in")
    kinds = {"double": 1.0, "decimal(9,3)": 2.0, "string": 3.0}
    for n, (kind, usd) in enumerate(kinds.items()):
        frame = landed(spark, (f"i{n}", usd, None, "2024-08-01")).withColumn("usd", F.col("usd").cast(kind))
        if kind == "string":
            bad = landed(spark, ("bad", None, None, "2024-08-01")).withColumn("usd", F.lit("n/a"))
            frame = frame.unionByName(bad)
        frame.coalesce(1).write.parquet(f"{stage.path}/{n}")
    done = load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 8, 3)).first()
    assert (done["files_failed"], done["rows_inserted"], done["rows_rejected"]) == (0, 3, 1)
    table = landing.open_prices(spark, f"{base}/prices").orderBy("id")
    assert [float(r["usd"]) for r in table.collect()] == [1.0, 2.0, 3.0]


def test_listing_tasks_do_not_follow_file_sizes(spark, base):
    for n in range(80):
        with open(f"{base}/{n}.parquet", "wb") as sparse:
            sparse.truncate(300 << 20)
    assert landing.price_stage(base).list_files(spark).rdd.getNumPartitions() <= landing.LIST_TASKS


def test_ranges_follow_the_rows(spark, base, prices):
    facts = prices(*[(f"i{n}", "1.00", None, "2024-01-01") for n in range(40)])
    landing.write_by_id(facts, f"{base}/by_id", rows_per_range=5)
    assert len(list(Path(f"{base}/by_id").glob("part-*"))) == 8


def test_old_versions_are_named(spark, base):
    table = versions.VersionedTable(spark, base, PRICES)
    for n in range(3):
        table.replace(spark.createDataFrame([(str(n), None, None, D1)], PRICES))
    assert [r["version"] for r in table.retired(keep=1).collect()] == [1, 2]
    assert table.retired().count() == 0


def test_other_failures_stop_a_load(spark, base):
    stage = landing.price_stage(f"{base}/in")
    landing.write_day(landed(spark, ("a", 1.0, None, "2024-08-01")), stage.path, D1)
    (Path(base) / "prices").write_text("not a directory")
    with pytest.raises(Exception):
        load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 8, 3))
    assert ledger.read_ledger(spark, f"{base}/ledger").count() == 0


def item_rows(spark, day, *names):
    blank = {f.name: None for f in LANDING_ITEMS}
    data = [tuple({**blank, "id": n.lower(), "name": n, "set": "fst", "pull_date": day.isoformat()}.values())
            for n in names]
    return spark.createDataFrame(data, LANDING_ITEMS)


def test_load_items(spark, base):
    stage, table = landing.item_stage(f"{base}/in"), versions.VersionedTable(spark, f"{base}/items", ITEMS)
    assert table.current().count() == 0
    landing.write_day(item_rows(spark, D2, "A", "B"), stage.path, D2)
    landing.write_day(item_rows(spark, D1, "a", "c"), stage.path, D1)
    first = load_items(spark, stage, table, D2).first()
    assert tuple(first)[:4] == (2, 0, 0, 2) and "2 inserted" in first["message"]
    assert tuple(load_items(spark, stage, table, D1).first())[:4] == (1, 0, 1, 1)
    assert sorted(r["name"] for r in table.current().collect()) == ["A", "B", "c"]
    assert {r["set_abbr"] for r in table.current().collect()} == {"fst"}
    later = date(2024, 8, 9)
    landing.write_day(item_rows(spark, later, "C"), stage.path, later)
    assert tuple(load_items(spark, stage, table, later).first())[:4] == (0, 1, 0, 1)
    assert sorted(r["name"] for r in table.current().collect()) == ["A", "B", "C"]


def test_a_failed_replace_leaves_the_table_alone(spark, base):
    table = versions.VersionedTable(spark, base, PRICES)
    good = spark.createDataFrame([("a", None, None, D1)], PRICES)
    table.replace(good)
    with pytest.raises(Exception):
        table.replace(good.withColumn("id", F.raise_error(F.lit("no"))))
    assert [r["id"] for r in table.current().collect()] == ["a"]


def test_file_checks(spark, base):
    stages = {"prices": landing.price_stage(f"{base}/p"), "items": landing.item_stage(f"{base}/i")}
    landing.write_day(landed(spark, ("a", 1.0, None, "2024-08-01")), stages["prices"].path, D1)
    landing.write_day(item_rows(spark, D1, "A"), stages["items"].path, D1)
    landing.write_day(item_rows(spark, D2, "A"), stages["items"].path, D2)
    files = checks.partition_files(spark, stages)
    assert all(r["file_name"].endswith(".parquet") and r["length"] > 0 for r in files.collect())
    summary = {(r["dataset"], r["pull_date"]): r["n_files"] for r in checks.partition_summary(files).collect()}
    assert summary == {("prices", D1): 1, ("items", D1): 1, ("items", D2): 1}
    expected = spark.createDataFrame([("prices", D1), ("prices", D2)], "dataset STRING, pull_date DATE")
    assert rows(checks.missing_days(files, expected)) == [("prices", D2)]


def test_file_size_and_name(spark):
    df = spark.createDataFrame([("a/b/c.parquet", 1572864), ("x", 5243)], "path STRING, length BIGINT")
    assert rows(df.select(file_name(F.col("path")), megabytes(F.col("length")))) == [("c.parquet", 1.5), ("x", 0.01)]


def test_day_count(prices):
    facts = prices(("a", "1", None, "2024-08-01"), ("b", None, None, "2024-08-01"))
    assert rows(checks.day_count(facts, D1)) == [(2,)]
    assert rows(checks.day_count(facts, D2)) == [(0,)]


def test_run_day_twice(spark, base, tmp_path):
    snapshot = tmp_path / "snapshot.json"
    snapshot.write_text(
        '{"id": "a", "name": "A", "released_at": "2024-01-01", "prices": {"usd": "2.00"}}\n'
        '{"id": "b", "name": "B", "released_at": "2024-01-01", "prices": {"usd": null}}\n'
        '{"name": "no id", "released_at": "2024-01-01", "prices": {"usd": "1.00"}}\n'
        '{"id": "broken'
    )
    lake = Lake(f"{base}/lake")
    first = {r["dataset"]: r["row_count"] for r in run_day(spark, str(snapshot), lake, D1).collect()}
    aside = {"records unreadable": 1, "prices rejected": 1, "items rejected": 1}
    assert first == {"prices": 2, "items": 3, "prices merged": 1, "items merged": 2, **aside}
    for _ in range(2):
        again = {r["dataset"]: r["row_count"] for r in run_day(spark, str(snapshot), lake, D1).collect()}
        assert again == {"prices": 2, "items": 3, "prices merged": 0, "items merged": 0, **aside}
    report = spark.read.option("header", True).csv(lake.report(D1))
    assert [(r["id"], r["today_price"]) for r in report.collect()] == [("a", "2.00")]
    assert rows(checks.day_count(landing.open_prices(spark, lake.prices), D1)) == [(1,)]
    items = lake.items(spark)
    assert items.current().count() == 2 and items.newest().number == 1
    # A later day renames the item; the report of the past day, repeated, keeps its name.
    later = tmp_path / "later.json"
    later.write_text('{"id": "a", "name": "Z", "released_at": "2024-01-01", "prices": {"usd": "3.00"}}')
    run_day(spark, str(later), lake, D2)
    run_day(spark, str(snapshot), lake, D1)
    names = [spark.read.option("header", True).csv(lake.report(d)).first()["name"] for d in (D1, D2)]
    assert names == ["A", "Z"]
