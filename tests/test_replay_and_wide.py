"""Rejected rows tried again, and the wide item table whose columns follow the snapshots."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from pricetrail.plans import loads, replay, wide
from pricetrail.plans.maintained import ItemStats, Maintained
from pricetrail.schemas import LANDING_PRICES
from pricetrail.sources import landing
from pricetrail.sources.evolving import EvolvingTable, evolved, reads_in_place, wider_type

D1, D2, D3 = date(2024, 8, 1), date(2024, 8, 2), date(2024, 8, 3)
TEXT = "id STRING, usd STRING, usd_foil STRING, pull_date STRING, currency STRING"


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def strip():
    """A rule for prices with a currency sign."""
    return {"usd": F.regexp_replace("usd", r"^\$", "")}


def land(spark, base, *values, day=D1):
    stage = landing.Stage(f"{base}/landing", LANDING_PRICES)
    landing.write_day(spark.createDataFrame(list(values), TEXT), stage.path, day)
    return stage


def load(spark, base, stage, turn=1, **more):
    return loads.load_prices(spark, stage, f"{base}/prices", f"{base}/ledger", datetime(2024, 8, turn), **more).first()


def counts(report):
    row = report.first()
    return row["rows_let_through"], row["rows_inserted"], row["rows_left"]


def curated(spark, base):
    return sorted((r["id"], str(r["usd"]), str(r["pull_date"])) for r in landing.open_prices(spark, f"{base}/prices").collect())


ROWS = [
    ("a", "1.50", None, "2024-08-01", "usd"),
    ("b", "$2.50", None, "2024-08-01", "usd"),
    ("c", "n/a", "7", "2024-08-01", "eur"),
    ("d", "$3", None, "first of August", None),
    (None, "$4", None, "2024-08-01", None),
    ("a", "$9", None, "2024-08-01", None),
]


def test_replay_lets_through_what_its_rules_mend(spark, base):
    stage = land(spark, base, *ROWS)
    assert load(spark, base, stage)["rows_rejected"] == 5
    assert counts(replay.replay_rejects(spark, f"{base}/prices", {})) == (0, 0, 5)
    assert counts(replay.replay_rejects(spark, f"{base}/prices", strip())) == (2, 1, 3)  # the table has a price of a
    assert curated(spark, base) == [("a", "1.50", "2024-08-01"), ("b", "2.50", "2024-08-01")]
    assert counts(replay.replay_rejects(spark, f"{base}/prices", strip())) == (0, 0, 3)
    rest = replay.outstanding_rejects(spark, f"{base}/prices/_rejects")
    assert {r["reject_record"]["usd"] for r in rest.collect()} == {"n/a", "$3", "$4"}
    by_currency = {"usd": F.when(F.col("reject_record")["currency"] == "eur", F.col("usd_foil")).otherwise(F.col("usd"))}
    assert counts(replay.replay_rejects(spark, f"{base}/prices", by_currency)) == (1, 1, 2)
    with pytest.raises(ValueError, match="price"):
        replay.replay_rejects(spark, f"{base}/prices", {"price": F.lit(1)})


def test_a_file_read_twice_rejects_its_rows_once(spark, base):
    stage = land(spark, base, *ROWS)
    load(spark, base, stage)
    loads.load_prices(spark, stage, f"{base}/prices", f"{base}/other ledger", datetime(2024, 8, 2))
    assert replay.outstanding_rejects(spark, f"{base}/prices/_rejects").count() == 5


def test_equal_rows_of_one_file_are_rows_of_their_own(spark, base):
    load(spark, base, land(spark, base, ROWS[1], ROWS[1], ROWS[1]))
    assert counts(replay.replay_rejects(spark, f"{base}/prices", strip())) == (3, 1, 0)


def test_an_interrupted_replay_is_repeated(spark, base, monkeypatch):
    load(spark, base, land(spark, base, *ROWS))
    write = replay.append_prices

    def stop_after(fresh, path):
        write(fresh, path)
        raise OSError("stopped")

    monkeypatch.setattr(replay, "append_prices", stop_after)
    with pytest.raises(OSError):
        replay.replay_rejects(spark, f"{base}/prices", strip())
    monkeypatch.undo()
    assert counts(replay.replay_rejects(spark, f"{base}/prices", strip())) == (2, 0, 3)
    assert len(curated(spark, base)) == 2


def test_replay_keeps_aggregates(spark, base):
    stats = ItemStats(spark, f"{base}/stats")
    maintained = Maintained(spark, f"{base}/prices", f"{base}/maintained", stats)
    load(spark, base, land(spark, base, *ROWS), maintained=maintained)
    replay.replay_rejects(spark, f"{base}/prices", strip(), maintained=maintained)
    assert {(r["id"], r["records"]) for r in stats.current().collect()} == {("a", 1), ("b", 1)}


def test_rows_without_a_file_are_told_by_their_values(spark, base):
    given = spark.createDataFrame([*ROWS, ROWS[1]], TEXT)
    assert loads.merge_prices(spark, given, f"{base}/prices", f"{base}/bad")["rows_rejected"] == 6
    assert replay.outstanding_rejects(spark, f"{base}/bad").count() == 5
    assert counts(replay.replay_rejects(spark, f"{base}/prices", strip(), f"{base}/bad")) == (2, 1, 3)


def test_nothing_rejected(spark, base):
    assert counts(replay.replay_rejects(spark, f"{base}/prices", strip())) == (0, 0, 0)
    load(spark, base, land(spark, base, ROWS[0]))
    assert counts(replay.replay_rejects(spark, f"{base}/prices", strip())) == (0, 0, 0)


def test_csv_files_and_columns_of_the_same_name(spark, base):
    stage = landing.Stage(f"{base}/landing", LANDING_PRICES, "csv", "*.csv")
    frame = spark.createDataFrame(ROWS[:2], TEXT).withColumn("reject_file", F.lit("mine"))
    frame.write.option("header", True).csv(stage.path)
    paths = [r["path"] for r in stage.list_files(spark).collect()]
    given = spark.read.option("header", True).csv(paths)
    assert loads.merge_prices(spark, given, f"{base}/prices", f"{base}/bad")["rows_rejected"] == 1
    frame.drop("reject_file").withColumn("Reject_Row", F.lit(1)).write.parquet(f"{base}/named")
    read = landing.Stage(f"{base}/named", LANDING_PRICES).read_files(spark, [f"{base}/named"])
    assert read.columns == [*frame.columns[:-1], "reject_file", "reject_row"]


# --- the wide table -----------------------------------------------------------------------


def snapshot(base, name, *records):
    with open(f"{base}/{name}.json", "w") as file:
        file.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    return f"{base}/{name}.json"


def outcome(report):
    row = report.first()
    return row["rows_inserted"], row["rows_updated"], row["rows_skipped"], row["rows_rejected"]


def values(table, *columns):
    return sorted(rows(table.current().select("id", *columns)))


def test_a_snapshot_adds_columns_and_widens_numbers(spark, base):
    table = wide.wide_table(spark, f"{base}/wide")
    first = snapshot(base, "first", {"id": "a", "edhrec_rank": 1}, {"id": "b", "edhrec_rank": 2.5}, {"id": "c", "cmc": 2.5})
    assert outcome(wide.load_wide(spark, first, table, D1)) == (3, 0, 0, 0)
    assert len(table.current().columns) == 101
    assert values(table, "edhrec_rank") == [("a", 1), ("b", None), ("c", None)]
    second = snapshot(
        base, "second", {"id": "a", "edhrec_rank": 3_000_000_000, "note": "n1", "Name": "no column", "seen": {"by": [1]}},
        {"id": "d", "note": 7, "ID": "x", "cmc": 3, "set_code": "not this"}, '{"id": "e", "no', {"name": "without id"},
    )
    assert outcome(wide.load_wide(spark, second, table, D2)) == (1, 1, 0, 2)
    assert table.current().columns[101:] == ["note", "seen"]
    assert table.current().schema["edhrec_rank"].dataType == T.LongType()
    assert values(table, "edhrec_rank", "note", "seen", "set_code") == [
        ("a", 3_000_000_000, "n1", '{"by": [1]}', None), ("b", None, None, None, None), ("c", None, None, None, None),
        ("d", None, "7", None, None),
    ]
    assert outcome(wide.load_wide(spark, first, table, D1)) == (0, 0, 3, 0)
    assert outcome(wide.load_wide(spark, first, table, D3)) == (0, 3, 0, 0)
    assert values(table, "edhrec_rank", "note")[0] == ("a", 1, None)  # the newer snapshot has no note
    third = snapshot(base, "third", {"id": "c", "edhrec_rank": 10**30}, {"id": "d", "edhrec_rank": "7 "}, {"id": "f", "edhrec_rank": 10**40})
    wide.load_wide(spark, third, table, date(2024, 8, 4))
    assert [(i, None if n is None else int(n)) for i, n in values(table, "edhrec_rank")] == [
        ("a", 1), ("b", None), ("c", 10**30), ("d", 7), ("f", None)
    ]
    assert wide.wide_table(spark, f"{base}/wide").current().schema == table.current().schema


def test_wider_numbers_leave_other_groups_where_they_are(spark, base):
    table = wide.wide_table(spark, f"{base}/wide", rows_per_group=10)
    wide.load_wide(spark, snapshot(base, "all", *[{"id": f"i{n}", "edhrec_rank": n} for n in range(40)]), table, D1)
    before = table.newest()
    wide.load_wide(spark, snapshot(base, "one", {"id": "i7", "edhrec_rank": 5_000_000_000, "note": "new"}), table, D2)
    after = table.newest()
    assert sum(after.parts[part] != path for part, path in before.parts.items()) == 1 < len(before.parts)
    assert values(table, "edhrec_rank", "note") == sorted(
        (f"i{n}", 5_000_000_000 if n == 7 else n, "new" if n == 7 else None) for n in range(40)
    )
    old = spark.read.parquet(*before.parts.values())  # a reader in flight
    assert old.count() == 40 and "note" not in old.columns


def test_folders_of_many_groups_are_listed_by_few_tasks(spark, base):
    """Each table that is read lists its 64 folders; a task for each of them was most of all tasks."""
    table = wide.wide_table(spark, f"{base}/wide", rows_per_group=1)
    wide.load_wide(spark, snapshot(base, "all", *[{"id": f"i{n}", "edhrec_rank": n} for n in range(64)]), table, D1)
    key, tracker = "spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.sparkContext.statusTracker()
    before = spark.conf.get(key)
    assert len(table.newest().parts) > 32
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        listed = table.current()
        stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
        tasks = [info.numTasks for s in stages if (info := tracker.getStageInfo(s))]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert tasks and max(tasks) <= 4
    assert spark.conf.get(key) == before and listed.count() == 64


def test_records_are_made_by_tasks_that_follow_their_number(spark, monkeypatch):
    from workload import frames

    sf = "/root/testdata/sf0.001"
    whole = sorted(map(str, frames.raw_items(spark, sf).collect()))
    monkeypatch.setattr(frames, "ROWS_PER_TASK", 50, raising=False)
    records = frames.raw_items(spark, sf)
    assert records.rdd.getNumPartitions() == -(-len(whole) // 50) > 1
    assert sorted(map(str, records.collect())) == whole


def test_empty_snapshots_and_left_out_fields(spark, base):
    table = wide.wide_table(spark, f"{base}/wide")
    assert outcome(wide.load_wide(spark, snapshot(base, "none"), table, D1)) == (0, 0, 0, 0)
    assert table.current().count() == 0
    path = snapshot(base, "more", {"id": "a", "x": 1, "Y": 2, "y": 3})
    assert wide.new_fields(spark, path) == ["Y", "x"]
    wide.load_wide(spark, path, table, D1, left_out=["X", "y"])
    assert len(table.current().columns) == 101


@pytest.mark.parametrize("layout", ["array", "array_lines"])
def test_arrays(spark, base, layout):
    path = f"{base}/array.json"
    with open(path, "w") as file:
        file.write('[\n{"id": "a", "note": 1.5},\n{"id": "b", "other": null}\n]')
    table = wide.wide_table(spark, f"{base}/wide")
    wide.load_wide(spark, path, table, D1, layout)
    assert values(table, "note", "other") == [("a", "1.5", None), ("b", None, None)]


def test_too_many_fields(spark, base):
    from pricetrail.sources.snapshots import snapshot_fields

    path = snapshot(base, "many", {f"f{n}": n for n in range(30)})
    assert len(snapshot_fields(spark, path, most=30)) == 30
    with pytest.raises(ValueError, match="29"):
        snapshot_fields(spark, path, most=29)


@pytest.mark.parametrize(
    "one, other, wider",
    [
        ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"),
        ("bigint", "double", "string"), ("float", "double", "double"), ("int", "decimal(5,2)", "decimal(12,2)"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,10)", "string"),
        ("date", "timestamp", "string"), ("boolean", "int", "string"), ("void", "date", "date"), ("date", "void", "date"),
        ("decimal(5,2)", "double", "string"), ("array<int>", "array<int>", "array<int>"),
    ],
)
def test_wider_types(spark, one, other, wider):
    def kind(text):
        return T.NullType() if text == "void" else T.StructType.fromDDL(f"x {text}")["x"].dataType

    assert wider_type(kind(one), kind(other)).simpleString() == wider
    assert wider_type(kind(other), kind(one)).simpleString() == wider


def test_nested_types_do_not_widen():
    with pytest.raises(ValueError, match="array"):
        wider_type(T.ArrayType(T.StringType()), T.StringType())


def test_schemas_evolve_by_name(spark, base):
    schema = T.StructType.fromDDL("id STRING, n INT, pull_date DATE")
    given = T.StructType.fromDDL("ID STRING, N BIGINT, pull_date DATE, extra BOOLEAN")
    whole = evolved(schema, given)
    assert whole == T.StructType.fromDDL("id STRING, n BIGINT, pull_date DATE, extra BOOLEAN")
    assert reads_in_place(schema, whole) and not reads_in_place(schema, T.StructType.fromDDL("id STRING, n STRING, pull_date DATE"))
    table = EvolvingTable(spark, f"{base}/t", schema, rows_per_group=4)
    table.upsert(spark.createDataFrame([(f"i{n}", n, D1) for n in range(20)], schema))
    texts = spark.createDataFrame([("i3", "three", D2), ("new", "4", D2)], "id STRING, n STRING, pull_date DATE")
    assert table.upsert(texts)["rows_merged"] == 2
    assert dict(rows(table.current().select("id", "n"))) == {**{f"i{n}": str(n) for n in range(20)}, "i3": "three", "new": "4"}
