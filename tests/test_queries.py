"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, rows_of
from conftest import plan_of
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    assert "EvalPython" not in plan_of(df)
    ours = rows_of(df.columns, df.collect())
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert ours == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_snapshot_arrays_are_one_whole_file_per_range(spark, tmp_path):
    import json

    from workload import frames

    records = frames.raw_items(spark, "/root/testdata/sf0.001")
    frames.write_arrays(records, f"{tmp_path}/arrays", 64)
    ids = [[int(x["id"]) for x in json.loads(f.read_text())] for f in sorted(tmp_path.glob("arrays/range=*/part-*"))]
    assert len(ids) == len({i // 64 for own in ids for i in own}) > 2
    assert all(own == sorted(own) and len({i // 64 for i in own}) == 1 for own in ids)
    assert sorted(i for own in ids for i in own) == sorted(int(r["id"]) for r in records.select("id").collect())
