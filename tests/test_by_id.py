"""The copy of the fact by item: its runs, levels, files and loads."""

from __future__ import annotations

import json
from datetime import date, timedelta

import pytest

from conftest import rows
from pricetrail.operators.lookup import item_history
from pricetrail.plans.daily import Lake, run_day
from pricetrail.plans.maintained import Maintained
from pricetrail.sources import by_id, landing
from pricetrail.sources.by_id import CopyById

DAY = date(2024, 8, 1)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def days(first, n_days, n_items=8):
    """Prices of some items on some days."""
    return [
        (f"i{i}", f"{i}.{d:02d}", None, (DAY + timedelta(days=d)).isoformat())
        for d in range(first, first + n_days) for i in range(n_items)
    ]


def test_runs_stay_few_and_rows_whole(spark, base, prices, items):
    copy = CopyById(spark, f"{base}/copy of prices", fanout=3, rows_per_file=5)
    written = []
    for d in range(10):
        copy.apply(prices(*days(d, 1)), f"day {d}")
        written.append(len(copy.newest().parts))
    assert sorted(rows(copy.current())) == sorted(rows(prices(*days(0, 10))))
    assert max(written) <= 4 and copy.newest().rows == 80
    for item in ("i0", "i3", "i7"):
        assert sorted(rows(copy.item(item))) == sorted(r for r in rows(copy.current()) if r[0] == item)
    history = item_history(copy.item("i3"), items({"id": "i3"}), "i3")
    assert history.count() == 10
    assert rows(copy.item("unknown")) == rows(copy.item("")) == []
    assert {r["load"] for r in copy.loads().collect()} == {f"day {d}" for d in range(10)}


def test_long_runs_are_sorted_by_as_many_tasks_as_there_are_cores(spark, base, prices, monkeypatch):
    monkeypatch.setattr(by_id, "SHORTEST_FILE", 10, raising=False)
    copy = CopyById(spark, base)
    copy.apply(prices(*[(f"i{i:03d}", "1", None, DAY.isoformat()) for i in range(80)]))
    assert len(copy.current().inputFiles()) == spark.sparkContext.defaultParallelism == 4
    assert len(copy.files_of("i007")) == 1
    copy.apply(prices(("x", "1", None, DAY.isoformat())))
    assert len(copy.current().inputFiles()) == 5 and copy.current().count() == 81


def test_levels_that_fill_in_turn_merge_at_once(spark, base, prices):
    copy = CopyById(spark, base, fanout=3)
    merges, merge_runs = [], copy.merge_runs
    copy.merge_runs = lambda: merges.append(merge_runs())
    for d in range(9):
        copy.apply(prices(*days(d, 1)), f"day {d}")
    assert merges == [0, 0, 1, 0, 0, 1, 0, 0, 1] and len(copy.newest().parts) == 1
    assert copy.newest().rows == 72 and sorted(rows(copy.current())) == sorted(rows(prices(*days(0, 9))))


def test_an_item_opens_one_file_of_a_run(spark, base, prices):
    copy = CopyById(spark, base, fanout=4, rows_per_file=10)
    for d in range(3):
        copy.apply(prices(*[(f"i{i:03d}", "1", None, (DAY + timedelta(days=d)).isoformat()) for i in range(200)]))
    assert len(copy.newest().parts) == 3 and copy.files_of("i000") and copy.files_of("i2") == []
    opened = [len(copy.files_of(f"i{i:03d}")) for i in range(200)]
    assert sum(opened) == 600 and set(opened) == {3}
    assert copy.item("i100").inputFiles() and len(copy.item("i100").inputFiles()) == 3


def test_a_hot_item_spreads_over_files(spark, base, prices):
    copy = CopyById(spark, base, rows_per_file=10)
    hot = [("hot", "1", None, (DAY + timedelta(days=d)).isoformat()) for d in range(40)]
    copy.apply(prices(*hot, *days(0, 5)))
    assert copy.item("hot").count() == 40 and len(copy.files_of("hot")) > 2 and len(copy.files_of("i1")) <= 2


def test_empty_loads_and_an_interrupted_merge(spark, base, prices, monkeypatch):
    copy = CopyById(spark, base, fanout=2)
    assert rows(copy.current()) == rows(copy.item("i1")) == []
    copy.apply(prices(), "nothing")
    assert copy.newest().parts == {} and rows(copy.loads()) == [("nothing",)]
    copy.apply(prices(*days(0, 1)), "first")
    monkeypatch.setattr(copy, "merge_runs", lambda: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        copy.apply(prices(*days(1, 1)), "second")
    monkeypatch.undo()
    assert copy.current().count() == 16 and len(copy.newest().parts) == 2
    before = copy.current()
    copy.apply(prices(*days(2, 1)), "third")
    assert len(copy.newest().parts) <= 2 and copy.current().count() == 24
    assert before.count() == 16 and copy.retired(1).count() > 0  # a reader in flight
    with pytest.raises(ValueError):
        CopyById(spark, base, fanout=1)


def test_the_daily_run_keeps_the_copy(spark, base):
    lake = Lake(f"{base}/lake")
    copy = CopyById(spark, f"{base}/copy", fanout=2)
    maintained = Maintained(spark, lake.prices, f"{base}/maintained", copy)
    for d in (0, 1, 1):
        path = f"{base}/{d}.json"
        with open(path, "w") as file:
            file.write("\n".join(json.dumps({"id": f"i{i}", "prices": {"usd": f"{i}.5{d}"}}) for i in range(4)))
        run_day(spark, path, lake, DAY + timedelta(days=d), maintained=maintained)
    assert sorted(rows(copy.current())) == sorted(rows(landing.open_prices(spark, lake.prices)))
    assert copy.item("i2").count() == 2
