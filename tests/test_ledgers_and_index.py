"""The name index against the plain search, one ledger for stream and batch, and reconciliation."""

from __future__ import annotations

import re
from datetime import date, datetime

import pytest

from conftest import plan_of, rows
from pricetrail.operators import checks
from pricetrail.operators.lookup import search_items
from pricetrail.plans.loads import load_prices
from pricetrail.schemas import LANDING_PRICES
from pricetrail.sources import landing, ledger
from pricetrail.sources.name_index import NameIndex
from pricetrail.streaming import ingest

D1, D2 = date(2024, 8, 1), date(2024, 8, 2)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def test_index_equals_the_scan(spark, base, prices, items):
    names = ["Dragon Lord", "dragonfly", "Élan é", "100% sure", "under_score", "a\\b", "xy", "", None, "Storm Dragon", "İstanbul"]
    table = items(*[{"id": f"i{n}", "name": name, "set_name": f"Set {n % 3} Storm"} for n, name in enumerate(names)],
                  {"id": None, "name": "Dragon without id"}, {"id": "i0", "name": "Dragon again"})
    facts = prices(*[(f"i{n}", f"{n}.50", None, "2024-08-01") for n in range(9)])
    index = NameIndex(spark, f"{base}/index")
    assert rows(index.search(facts, table, "dragon")) == []  # an index of nothing knows nothing
    index.update(table.limit(4))
    index.update(table)
    index.update(table)
    terms = [("dragon", "storm"), ("DRAGON", None), ("é", None), ("Élan", ""), ("100%", None), ("der_s", None), ("a\\b", None),
             ("xy", "set 1"), ("", "torm"), (None, None), ("nothing like it", None), ("agon l", "et 0 s"), ("İstan", None)]
    for name, set_name in terms:
        assert rows(index.search(facts, table, name, set_name)) == rows(search_items(facts, table, name, set_name)), (name, set_name)
    renamed = items({"id": "i1", "name": "Wyvern"}, {"id": "i2", "name": "dragons"})
    index.update(renamed)
    for name in ("dragon", "wyvern"):
        assert rows(index.search(facts, renamed, name)) == rows(search_items(facts, renamed, name))


def test_a_search_reads_its_own_postings(spark, base, items):
    index = NameIndex(spark, f"{base}/index")
    index.update(items(*[{"id": f"i{n}", "name": f"name {n * 7919}"} for n in range(300)]))
    text = plan_of(index._matches("name", "7919"))
    folders = re.search(r"PartitionFilters: \[([^\n]*?)\], PushedFilters: \[([^\n]*?)\]", text)
    assert "(field" in folders[1] and "= name)" in folders[1] and len(set(re.findall(r"\d+", folders[1].split(" IN ")[1]))) <= 2
    assert folders[2].endswith("In(run, [791,919")


def arrive(spark, stage, day, *values):
    landing.write_day(spark.createDataFrame(list(values), LANDING_PRICES), stage.path, day)


@pytest.mark.parametrize("broken", ["before the entry", "after the entry"])
def test_a_stream_killed_around_its_entry_adds_nothing_on_restart(spark, base, monkeypatch, broken):
    stage = landing.price_stage(f"{base}/in")
    arrive(spark, stage, D1, ("a", 1.0, None, "2024-08-01"), ("b", 2.0, None, "2024-08-01"))
    real = ledger.record_files

    def lost(*given):
        if broken == "after the entry":
            real(*given)
        raise RuntimeError("lost")

    def run():
        ingest.merge_stream(spark, stage, f"{base}/out", f"{base}/check", ledger_path=f"{base}/ledger").awaitTermination()

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "record_files", lost)
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    entries = ledger.read_ledger(spark, f"{base}/ledger")
    assert landing.open_prices(spark, f"{base}/out").count() == 2
    assert entries.count() == entries.select("file_name").distinct().count() > 0
    # A batch finds nothing to load there, and the stream nothing of what a batch has loaded.
    report = load_prices(spark, stage, f"{base}/out", f"{base}/ledger", datetime(2024, 8, 3)).first()
    assert (report["files_loaded"], report["rows_inserted"]) == (0, 0)
    arrive(spark, stage, D2, ("a", 3.0, None, "2024-08-02"))
    assert load_prices(spark, stage, f"{base}/out", f"{base}/ledger", datetime(2024, 8, 4)).first()["rows_inserted"] == 1
    n = ledger.read_ledger(spark, f"{base}/ledger").count()
    run()
    assert ledger.read_ledger(spark, f"{base}/ledger").count() == n
    assert landing.open_prices(spark, f"{base}/out").count() == 3


def test_reconciliation(spark):
    days = checks.calendar(spark, date(2024, 8, 1), date(2024, 8, 7))
    day = lambda n: date(2024, 8, n)
    files = spark.createDataFrame([(day(n), f"f{n}") for n in (1, 2, 2, 4, 6)] + [(day(2), "late"), (None, "odd")], "pull_date DATE, path STRING")
    entries = spark.createDataFrame([(f"f{n}",) for n in (1, 2, 4, 4, 6)], "file_name STRING")
    landed = spark.createDataFrame([(str(day(n)),) for n in (1, 1, 2, 4, 4, 6)] + [(None,)], "pull_date STRING")
    curated = spark.createDataFrame([(day(n),) for n in (1, 1, 2, 4, 7)], "pull_date DATE")
    found = checks.reconcile_days(days, files, entries, landed, curated)
    states = {r["pull_date"].day: r["state"] for r in found.collect()}
    assert states == {1: "complete", 2: "not loaded", 3: "missing", 4: "short", 5: "missing", 6: "short", 7: "complete"}
    assert sorted(rows(checks.day_ranges(found))) == [(day(3), day(3), 1), (day(5), day(5), 1)]
    assert rows(checks.day_ranges(found, "complete").filter("n_days > 1")) == []
