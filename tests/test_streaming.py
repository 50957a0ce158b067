from __future__ import annotations

from datetime import date, datetime

import pytest

from conftest import rows
from pricetrail.operators.conform import conform
from pricetrail.operators.merge import merge_insert_only
from pricetrail.plans.loads import load_prices
from pricetrail.schemas import ITEMS, LANDING_ITEMS, LANDING_PRICES, PRICES
from pricetrail.sources import landing
from pricetrail.sources.versions import VersionedTable
from pricetrail.streaming import ingest

D1, D2 = date(2024, 8, 1), date(2024, 8, 2)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def arrive(spark, stage, day, *values):
    landing.write_day(spark.createDataFrame(list(values), LANDING_PRICES), stage.path, day)


def test_append_reads_each_file_once(spark, base):
    stage = landing.price_stage(f"{base}/in")

    def run():
        ingest.append_stream(spark, stage, f"{base}/out", f"{base}/check", max_files=1).awaitTermination()
        ingest.reject_stream(spark, stage, f"{base}/bad", f"{base}/check_bad").awaitTermination()
        return spark.read.schema(PRICES).parquet(f"{base}/out")

    arrive(spark, stage, D1, ("a", 1.25, None, "2024-08-01"), ("b", 1.0, None, "no date"))
    assert run().count() == 1
    assert run().count() == 1
    arrive(spark, stage, D2, ("a", 2.0, 3.0, "2024-08-02"))
    table = run()
    assert table.count() == 2
    assert [r["id"] for r in spark.read.parquet(f"{base}/bad").collect()] == ["b"]


def test_one_kind_of_writer_per_table(spark, base):
    stage, late = landing.price_stage(f"{base}/in"), landing.price_stage(f"{base}/late")
    arrive(spark, stage, D1, ("a", 1.0, None, "2024-08-01"), (None, 1.0, None, "2024-08-01"), ("b", 1.0, None, None))
    ingest.append_stream(spark, stage, f"{base}/own", f"{base}/c1").awaitTermination()
    assert spark.read.schema(PRICES).parquet(f"{base}/own").count() == 1  # rows without id or date are rejects
    with pytest.raises(ValueError):
        load_prices(spark, stage, f"{base}/own", f"{base}/ledger", datetime(2024, 8, 3))
    load_prices(spark, stage, f"{base}/shared", f"{base}/ledger", datetime(2024, 8, 3))
    with pytest.raises(ValueError):
        ingest.append_stream(spark, stage, f"{base}/shared", f"{base}/c2")
    arrive(spark, late, D2, ("a", 2.0, None, "2024-08-02"))
    ingest.merge_stream(spark, late, f"{base}/shared", f"{base}/c3").awaitTermination()
    arrive(spark, stage, D2, ("c", 3.0, None, "2024-08-02"))
    load_prices(spark, stage, f"{base}/shared", f"{base}/ledger", datetime(2024, 8, 4))
    assert landing.open_prices(spark, f"{base}/shared").count() == 3
    assert spark.read.parquet(f"{base}/shared/_rejects/load=20240803T000000/from=0").count() == 2


def test_stream_merge_equals_batch_merge(spark, base):
    stage = landing.price_stage(f"{base}/in")
    first = [("a", 1.0, None, "2024-08-01"), ("b", 2.0, None, "2024-08-01"), ("b", 2.0, None, None)]
    late = [("a", 9.0, None, "2024-08-01"), ("c", 3.0, None, "2024-08-01"), ("a", 4.0, None, "2024-08-02")]
    target = conform(spark.createDataFrame([], LANDING_PRICES), PRICES)
    for day, values in ((D1, first), (D2, late), (D1, first)):
        arrive(spark, stage, day, *values)
        ingest.merge_stream(spark, stage, f"{base}/out", f"{base}/check", f"{base}/bad").awaitTermination()
        batch = conform(spark.createDataFrame(values, LANDING_PRICES), PRICES)
        target = merge_insert_only(target, batch, keyless=False)
    streamed = landing.open_prices(spark, f"{base}/out").select(target.columns)
    assert sorted(rows(streamed), key=str) == sorted(rows(target), key=str)
    assert streamed.count() == 4
    assert spark.read.parquet(f"{base}/bad").filter("id = 'b'").count() == 2


def test_older_items_do_not_overwrite(spark, base):
    stage, table = landing.item_stage(f"{base}/in"), VersionedTable(spark, f"{base}/items", ITEMS)
    blank = {f.name: None for f in LANDING_ITEMS}
    for day, names in ((D2, "AB"), (D1, "abc")):
        values = [
            tuple({**blank, "id": n.lower(), "name": n, "pull_date": day.isoformat()}.values()) for n in names
        ]
        landing.write_day(spark.createDataFrame(values, LANDING_ITEMS), stage.path, day)
        ingest.upsert_stream(spark, stage, table, f"{base}/check").awaitTermination()
    assert sorted(r["name"] for r in table.current().collect()) == ["A", "B", "c"]
