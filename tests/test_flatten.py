from __future__ import annotations

import json
from datetime import date

import pytest

from conftest import rows
from pricetrail.operators.flatten import daily_prices, flatten_wide, static_fields, wide_schema
from pricetrail.schemas import LANDING_ITEMS, RAW_WIDE
from pricetrail.sources.snapshots import read_snapshot, snapshot_rejects

DAY = date(2025, 5, 3)
RECORDS = [
    {"id": "a", "mtgo_id": 12, "tcgplayer_id": 34.0, "set": "fst", "prices": {"usd": "1.50", "usd_foil": None}},
    {"id": "b", "mtgo_id": "x", "prices": {"usd": "n/a", "usd_foil": "2"}},
    {"id": "c", "prices": {"usd": None, "usd_foil": None}},
    {"id": "d", "prices": {"usd": "oops"}},
    {"id": "e"},
    {"id": "f", "prices": {"eur": "3"}, "unknown": [1, 2]},
]


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "snapshot.json"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS))
    return str(path)


def test_daily_prices(spark, lines):
    got = rows(daily_prices(read_snapshot(spark, lines), DAY))
    assert sorted(got) == [
        ("a", 1.5, None, "2025-05-03"),
        ("b", None, 2.0, "2025-05-03"),
        ("d", None, None, "2025-05-03"),  # quoted, though not a number
    ]


def test_static_fields(spark, lines):
    got = static_fields(read_snapshot(spark, lines), DAY)
    assert got.columns == LANDING_ITEMS.fieldNames()
    by_id = {r["id"]: r for r in got.collect()}
    assert len(by_id) == 6
    assert (by_id["a"]["mtgo_id"], by_id["a"]["tcgplayer_id"], by_id["a"]["set"]) == (12.0, 34.0, "fst")
    assert by_id["b"]["mtgo_id"] is None and by_id["e"]["name"] is None


@pytest.mark.parametrize("layout", ["array", "array_lines"])
def test_array_layouts(spark, tmp_path, lines, layout):
    path = tmp_path / "array.json"
    expected = sorted(rows(read_snapshot(spark, lines)), key=str)
    for start, end in (("[\n", "\n]\n"), ("[", "]"), ("  [ ", " ] \n\n")):
        path.write_text(start + " ,\n".join(json.dumps(r) for r in RECORDS) + end)
        got = read_snapshot(spark, str(path), layout=layout)
        assert sorted(rows(got), key=str) == expected


def test_pretty_printed_array(spark, tmp_path):
    path = tmp_path / "array.json"
    path.write_text(json.dumps(RECORDS, indent=2))
    assert read_snapshot(spark, str(path), layout="array").count() == len(RECORDS)


def test_unknown_layout(spark, lines):
    with pytest.raises(ValueError):
        read_snapshot(spark, lines, layout="csv")


@pytest.mark.parametrize("layout", ["lines", "array_lines"])
def test_malformed_lines_are_set_aside(spark, tmp_path, layout):
    path = tmp_path / "bad.json"
    path.write_text('{"id": "a"}\n{"id": "b", "pri\n{"id": "c"}')
    assert [r["id"] for r in read_snapshot(spark, str(path), layout=layout).collect()] == ["a", "c"]
    assert rows(snapshot_rejects(spark, str(path), layout=layout)) == [('{"id": "b", "pri',)]


def test_malformed_array_file(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('[{"id": "a"}, {"id": ')
    assert snapshot_rejects(spark, str(path), layout="array").count() >= 1


WIDE = {
    "id": "a", "set": "fst", "released_at": "2025-01-31", "cmc": 2.5, "edhrec_rank": 9, "foil": True,
    "colors": ["W", "U"], "keywords": [], "multiverse_ids": [1, 2],
    "legalities": {"modern": "legal"}, "image_uris": {"png": "p"}, "purchase_uris": {"tcgplayer": "t"},
    "preview": {"previewed_at": "2025-01-02", "source": "s"},
    "card_faces": [{"name": "F", "power": "1"}, {"name": "B"}],
}


def test_wide(spark, tmp_path):
    path = tmp_path / "wide.json"
    flawed = {"id": "b", "foil": "maybe", "released_at": "soon", "card_faces": [{"name": "only"}]}
    path.write_text("\n".join(json.dumps(r) for r in (WIDE, flawed, {"id": "c"})))
    got = flatten_wide(read_snapshot(spark, str(path), RAW_WIDE), DAY)
    assert len(got.columns) == 101 and got.columns == list(wide_schema())
    a, b, c = sorted(got.collect(), key=lambda r: r["id"])
    assert (a["set_code"], a["released_at"], a["cmc"], a["edhrec_rank"]) == ("fst", date(2025, 1, 31), "2.5", 9)
    assert (a["colors"], a["keywords"], a["multiverse_ids"], a["foil"]) == ("W,U", "", "1,2", True)
    assert (a["legalities_modern"], a["legalities_standard"], a["image_uris_png"]) == ("legal", None, "p")
    assert (a["purchase_uris_tcgplayer"], a["preview_previewed_at"]) == ("t", date(2025, 1, 2))
    assert (a["card_faces_front_name"], a["card_faces_front_power"]) == ("F", "1")
    assert (a["card_faces_back_name"], a["card_faces_back_power"]) == ("B", None)
    assert (b["foil"], b["released_at"]) == (None, None)  # one bad value costs one field
    assert (b["card_faces_front_name"], b["card_faces_back_name"]) == ("only", None)
    assert c["colors"] is None and c["card_faces_front_name"] is None and c["pull_date"] == DAY
