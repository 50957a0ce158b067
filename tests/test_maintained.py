"""Tables in groups, kept aggregates, and compacted days: what they write, what readers see, what a failure leaves."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from pricetrail.operators import maintained as kept
from pricetrail.operators.curves import curve_from_state, launch_curve
from pricetrail.operators.lookup import search_items, search_stats
from pricetrail.operators.merge import new_price_rows, upsert_newer_wins
from pricetrail.plans.maintained import ItemStats, LaunchState, Maintained
from pricetrail.sources import compaction, landing
from pricetrail.sources.versions import VersionedTable

D = date(2024, 8, 1)
ITEM = "id STRING, name STRING, pull_date DATE"


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def named(spark, ids, day, prefix="n"):
    return spark.createDataFrame([(f"i{n}", f"{prefix}{n}", day) for n in ids], ITEM)


def files(path):
    return {str(p) for p in Path(path).rglob("part-*.parquet")}


def test_a_load_writes_only_the_groups_that_it_changes(spark, base):
    first = named(spark, range(400), D)
    table = VersionedTable(spark, f"{base}/items", first.schema, rows_per_group=50)
    assert table.upsert(first)["rows_inserted"] == 400
    old, before = table.newest(), files(f"{base}/items/data")
    assert len(old.parts) == 8 and old.rows == 400
    reader = table.current()
    reader.count()
    one = table.current().withColumn("g", table._group(8)).filter("g = 3").limit(4).drop("g")
    later = one.withColumns({"pull_date": F.lit(D + timedelta(1)), "name": F.upper("name")})
    later = spark.createDataFrame(later.collect(), first.schema)
    assert table.upsert(later) == {"rows_inserted": 0, "rows_updated": 4, "rows_skipped": 0, "rows_merged": 4}
    new = table.newest()
    assert {p for p in new.parts if new.parts[p] != old.parts[p]} == {"3of8"}
    added = files(f"{base}/items/data") - before
    assert added and all("id_group=3" in f for f in added)
    assert sorted(rows(table.current())) == sorted(rows(upsert_newer_wins(first, later)))
    assert reader.filter("name LIKE 'N%'").count() == 0  # the reader in flight sees its version
    # The same load again, or an older one, writes nothing.
    assert table.upsert(later)["rows_skipped"] == 4 and table.upsert(first)["rows_merged"] == 0
    assert table.newest().number == 2
    gone = table.retired(keep=1).collect()
    assert [(r["version"], r["part"]) for r in gone] == [(1, "3of8")]


def test_groups_follow_the_rows(spark, base):
    table = VersionedTable(spark, f"{base}/items", named(spark, [1], D).schema, rows_per_group=10)
    for last in (9, 25, 300):
        table.upsert(named(spark, range(last), D))
        assert table.newest().rows == table.current().count() == last
    assert len(table.newest().parts) == 32
    assert rows(table.retired(keep=5)) == []


def test_upsert_of_nothing_and_of_copies(spark, base):
    table = VersionedTable(spark, f"{base}/items", named(spark, [1], D).schema)
    assert table.upsert(named(spark, [1], D).limit(0))["rows_merged"] == 0
    assert table.newest().number == 0 and table.current().count() == 0
    assert table.upsert(named(spark, [1, 1, 2], D))["rows_inserted"] == 2
    assert table.newest().rows == 2


def traded(prices, n, day, foil=True, ids=range(12)):
    given = [(f"i{i}", f"{n + i}.37", f"{n + 2 * i}.11" if foil and i % 3 else None, str(day)) for i in ids]
    return prices(*given)


def market(items, turn):
    made = [
        {"id": f"i{i}", "name": f"name {i}", "released_at": str(D + timedelta(i % 4 - 2 + 9 * (turn and i % 5 == 0))),
         "set_name": f"set {i % 2}", "rarity": ("rare", "common")[(i + turn) % 2 if i == 3 else i % 2]}
        for i in range(10 + turn)
    ]
    return items(*made)


def same_as_the_fact(spark, path, item_table, stats, launch):
    fact = landing.open_prices(spark, path)
    assert rows(search_stats(stats.current(), item_table)) == rows(search_items(fact, item_table))
    for settings in ({}, {"price": "usd_foil", "days": (-45, 0)}, {"set_names": ("set 1",), "by_rarity": True, "released_from": None}):
        settings = {"released_from": date(2024, 7, 1), "days": (-45, 300), **settings}
        assert rows(curve_from_state(launch.state(), **settings)) == rows(launch_curve(fact, item_table, **settings))


def load(maintained, spark, path, source):
    maintained.recover()
    return maintained.append(new_price_rows(landing.open_prices(spark, path), source, keyless=False))


def test_states_equal_the_fact(spark, base, prices, items):
    path = f"{base}/prices"
    stats, launch = ItemStats(spark, f"{base}/stats", rows_per_group=4), LaunchState(spark, f"{base}/launch")
    own = Maintained(spark, path, f"{base}/m", stats, launch)
    assert own.update_items(market(items, 0)) == 10
    assert load(own, spark, path, traded(prices, 1, D)) == 12
    assert load(own, spark, path, traded(prices, 5, D + timedelta(40), foil=False)) == 12
    # Late rows of a known day, and rows that are there already.
    assert load(own, spark, path, traded(prices, 9, D, ids=range(8, 15))) == 3
    same_as_the_fact(spark, path, market(items, 0), stats, launch)
    version = launch.newest()
    assert load(own, spark, path, traded(prices, 9, D)) == 0
    assert launch.newest() == version
    # Other release dates, another rarity, and an item whose prices were there before it.
    assert own.update_items(market(items, 1)) == 4
    same_as_the_fact(spark, path, market(items, 1), stats, launch)
    assert own.update_items(market(items, 1)) == 0
    # A day of one month leaves the other months' parts where they are.
    before = launch.newest().parts
    load(own, spark, path, traded(prices, 3, D + timedelta(41)))
    assert {m for m, p in launch.newest().parts.items() if p != before.get(m)} == {"2024-09"}
    same_as_the_fact(spark, path, market(items, 1), stats, launch)
    assert own.retired().count() == 4


@pytest.mark.parametrize("breaks", ["fact", "stats", "launch"])
def test_an_interrupted_load_is_finished_once(spark, base, prices, items, monkeypatch, breaks):
    path = f"{base}/prices"
    stats, launch = ItemStats(spark, f"{base}/stats"), LaunchState(spark, f"{base}/launch")
    own = Maintained(spark, path, f"{base}/m", stats, launch)
    own.update_items(market(items, 0))
    load(own, spark, path, traded(prices, 1, D))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if breaks == "fact":
            patch.setattr("pricetrail.plans.maintained.append_prices", fail)
        else:
            patch.setattr(stats if breaks == "stats" else launch, "apply", fail)
        with pytest.raises(RuntimeError):
            load(own, spark, path, traded(prices, 2, D + timedelta(1)))
    assert own.recover() == 1 and own.recover() == 0
    assert load(own, spark, path, traded(prices, 2, D + timedelta(1))) == 0
    assert landing.open_prices(spark, path).count() == 24
    same_as_the_fact(spark, path, market(items, 0), stats, launch)


def test_a_new_state_takes_in_the_fact(spark, base, prices, items):
    path = f"{base}/prices"
    landing.append_prices(traded(prices, 1, D), path)
    load(Maintained(spark, path, f"{base}/m", ItemStats(spark, f"{base}/other")), spark, path, traded(prices, 2, D + timedelta(1)))
    stats, launch = ItemStats(spark, f"{base}/stats"), LaunchState(spark, f"{base}/launch")
    own = Maintained(spark, path, f"{base}/m", stats, launch)
    own.update_items(market(items, 0))
    load(own, spark, path, traded(prices, 3, D + timedelta(2)))
    same_as_the_fact(spark, path, market(items, 0), stats, launch)


def test_reads_leave_the_fact_alone(spark, base, prices, items):
    path = f"{base}/prices"
    stats, launch = ItemStats(spark, f"{base}/stats"), LaunchState(spark, f"{base}/launch")
    own = Maintained(spark, path, f"{base}/m", stats, launch)
    own.update_items(market(items, 0))
    load(own, spark, path, traded(prices, 1, D))
    for read in (search_stats(stats.current(), market(items, 0)), curve_from_state(launch.state())):
        assert not [f for f in read.inputFiles() if "/prices/" in f]
        assert "PartitionFilters: [isnotnull(pull_date" not in plan_of(read)


def test_signed_sums_cancel(prices, items):
    old, new = kept.traits(market(items, 0)), kept.traits(market(items, 1))
    fact = traded(prices, 1, D)
    moved = kept.merged_launch(kept.launch_rows(fact, old), kept.moved_launch_rows(fact, kept.changed_traits(old, new)))
    assert sorted(rows(moved), key=str) == sorted(rows(kept.launch_rows(fact, new)), key=str)


def test_compacted_days(spark, base, prices):
    path = f"{base}/prices"
    for n in range(6):
        landing.append_prices(traded(prices, n, D, ids=range(3 * n, 3 * n + 3)), path)
    landing.append_prices(traded(prices, 1, D + timedelta(1)), path)
    before = sorted(rows(landing.open_prices(spark, path)), key=str)
    reader = landing.open_prices(spark, path)
    report = compaction.compact_days(spark, path)
    assert [(r["pull_date"], r["n_files"], r["n_bins"]) for r in report.collect()] == [(D, 6, 1)]
    assert sorted(rows(landing.open_prices(spark, path)), key=str) == before == sorted(rows(reader), key=str)
    live = compaction.data_files(spark, path).filter("live")
    assert live.groupBy("pull_date").count().filter("count > 1").count() == 0
    assert compaction.retired_files(spark, path).count() == 6
    # A repeat changes nothing; later rows of both kinds of day are seen, merged and compacted again.
    assert compaction.compact_days(spark, path).count() == 0
    for n in (50, 60, 70):
        both = traded(prices, n, D, ids=[n]).unionByName(traded(prices, n, D + timedelta(1), ids=[n]))
        source = both.unionByName(traded(prices, 99, D, ids=[0, 1]))
        assert landing.append_prices(new_price_rows(landing.open_prices(spark, path), source, keyless=False), path) == 2
    whole = sorted(rows(landing.open_prices(spark, path)), key=str)
    assert len(whole) == len(before) + 6
    assert compaction.compact_days(spark, path).count() == 2
    assert sorted(rows(landing.open_prices(spark, path)), key=str) == whole
    text = plan_of(landing.open_prices(spark, path).filter(F.col("pull_date") == F.lit(D)))
    assert "PartitionFilters" in text and "generation" in text


def test_an_interrupted_compaction_changes_nothing(spark, base, prices, monkeypatch):
    path = f"{base}/prices"
    for n in range(4):
        landing.append_prices(traded(prices, n, D, ids=[n]), path)

    def half(df, write, *columns, **metrics):
        landing.write_observed(df, write, *columns, **metrics)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "write_observed", half)
        with pytest.raises(RuntimeError):
            compaction.compact_days(spark, path)
    assert landing.open_prices(spark, path).count() == 4
    compaction.compact_days(spark, path)
    assert landing.open_prices(spark, path).count() == 4


def test_bins_follow_the_sizes(spark):
    sizes = [10, 20, 30, 40, 50, 200]
    given = spark.createDataFrame([(D, f"f{n}", s, True) for n, s in enumerate(sizes)], "pull_date DATE, path STRING, length LONG, live BOOLEAN")
    found = compaction.packed_days(given, 100).first()
    assert (found["n_files"], found["n_bins"], found["length"]) == (6, 2, 350)
    assert compaction.compact_days(spark, "/tmp/there-is-no-such-table").count() == 0
