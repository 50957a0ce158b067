from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pricetrail.functions.columns import price_ratio, years_before
from pricetrail.operators.movers import lookback_slice, movers_from_slice, price_movers, top_movers

AS_OF = date(2025, 1, 29)
TODAY, W1, W2, W4 = "2025-01-29", "2025-01-22", "2025-01-15", "2025-01-01"


@pytest.fixture
def market(prices, items):
    return (
        prices(
            ("up", "4.00", None, TODAY), ("up", "2.00", None, W1), ("up", "3.00", None, W2), ("up", "1.00", None, W4),
            ("down", "1.00", None, TODAY), ("down", "3.00", None, W4),
            ("new", "9.00", None, TODAY),
            ("cheap", "0.99", None, TODAY), ("cheap", "0.50", None, W4),
            ("gone", "5.00", None, W1),
            ("zero", "0.00", None, TODAY), ("zero", "5.00", None, W4),
            ("null", None, "7.00", TODAY),
            ("halfzero", "6.00", None, TODAY), ("halfzero", "0.00", None, W4),
            ("old", "8.00", None, TODAY),
            ("unknown", "8.00", None, TODAY),
            ("up", "77.00", None, "2025-01-28"),
        ),
        items(
            *({"id": i} for i in ("up", "down", "new", "cheap", "gone", "zero", "null", "halfzero")),
            {"id": "old", "released_at": "2015-01-28"},
        ),
    )


def test_movers_report(market):
    report = price_movers(*market, AS_OF)
    assert report.columns == [
        "id", "tcgplayer_id", "name", "set_name", "set_type", "released_at", "today_price", "today_price_date",
        "1wk_ago_price", "2wk_ago_price", "4wk_ago_price", "1wk_diff", "2wk_diff", "4wk_diff",
    ]
    got = {r["id"]: r for r in report.collect()}
    assert list(got) == ["up", "down", "halfzero", "new"]
    up = got["up"]
    assert (up["today_price"], up["1wk_ago_price"], up["4wk_ago_price"]) == (D("4.00"), D("2.00"), D("1.00"))
    assert (up["1wk_diff"], up["2wk_diff"], up["4wk_diff"]) == (2.0, 1.3333, 4.0)
    assert up["today_price_date"] == AS_OF
    assert up["tcgplayer_id"] == "https://www.tcgplayer.com/product/5"
    assert got["down"]["1wk_ago_price"] is None and got["down"]["1wk_diff"] is None
    assert got["halfzero"]["4wk_ago_price"] is None and got["halfzero"]["4wk_diff"] is None


def test_both_ways_agree(market):
    prices, items = market
    from_slice = movers_from_slice(lookback_slice(prices, items, AS_OF), AS_OF)
    assert rows(from_slice) == rows(price_movers(prices, items, AS_OF))


def test_repeated_item_gives_one_row(prices, items):
    facts = prices(("a", "2.00", None, TODAY))
    twice = items({"id": "a", "name": "B"}, {"id": "a", "name": "A"})
    assert [r["name"] for r in price_movers(facts, twice, AS_OF).collect()] == ["A"]


def test_no_qualifying_row_keeps_the_schema(prices, items):
    report = price_movers(prices(), items(), AS_OF)
    assert report.count() == 0 and len(report.columns) == 14


def test_missing_external_id_has_no_url(prices, items):
    report = price_movers(prices(("a", "2.00", None, TODAY)), items({"id": "a", "tcgplayer_id": None}), AS_OF)
    assert report.first()["tcgplayer_id"] is None


def test_default_clock_is_today(spark, items):
    facts = spark.sql("SELECT 'a' AS id, CAST(3 AS DECIMAL(10,2)) AS usd, CAST(NULL AS DECIMAL(10,2)) AS usd_foil, "
                      "current_date() AS pull_date")
    known = items({"id": "a"}).withColumn("released_at", F.current_date())
    assert price_movers(facts, known).count() == 1


@pytest.mark.parametrize(
    "now, then, expected",
    [
        ("1.00005", "1", 1.0001),  # scaled to 10000.5 plus a hair in binary, not a tie
        ("1", "3", 0.3333),
        ("1.00015", "1", 1.0002),
        ("0", "3", None),
        ("3", "0", None),
        (None, "3", None),
        ("3", None, None),
    ],
)
def test_ratio(spark, now, then, expected):
    df = spark.createDataFrame([(now, then)], "a STRING, b STRING")
    a, b = (F.col(c).cast("decimal(10,5)") for c in "ab")
    assert df.select(price_ratio(a, b)).first()[0] == expected


def test_leap_day(spark):
    got = spark.range(1).select(years_before(date(2024, 2, 29), 1), years_before(date(2024, 2, 29), 4)).first()
    assert tuple(got) == (date(2023, 2, 28), date(2020, 2, 29))


def test_top_movers(market):
    movers = price_movers(*market, AS_OF)
    top = top_movers(movers, 1)
    assert [(r["direction"], r["id"]) for r in top.collect()] == [("up", "up"), ("down", "down")]
    week = top_movers(movers, 5, by="1wk_diff")
    assert [(r["direction"], r["id"]) for r in week.collect()] == [("up", "up"), ("down", "up")]
