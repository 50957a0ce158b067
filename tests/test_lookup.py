from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest

from conftest import rows
from pricetrail.functions.table_functions import register_item_prices, register_item_search
from pricetrail.operators.lookup import item_history, lookup_join, search_items


@pytest.fixture
def market(prices, items):
    return (
        prices(
            ("a", "1.00", None, "2024-01-02"), ("a", "2.00", "4.00", "2024-01-01"), ("a", "1.01", None, "2024-01-03"),
            ("b", None, None, "2024-01-01"),
            ("stray", "3.00", None, "2024-01-01"),
        ),
        items(
            {"id": "a", "name": "Red Squall", "set_name": "Final"},
            {"id": "b", "name": "100% Wool", "set_name": "Final"},
            {"id": "c", "name": "back\\slash", "set_name": "Other", "tcgplayer_id": None},
            {"id": "d", "name": None, "set_name": "Other"},
        ),
    )


def names(df):
    return [r["name"] for r in df.collect()]


def test_history_in_date_order(market):
    assert rows(item_history(*market, "a")) == [
        ("Red Squall", D("2.00"), D("4.00"), date(2024, 1, 1)),
        ("Red Squall", D("1.00"), None, date(2024, 1, 2)),
        ("Red Squall", D("1.01"), None, date(2024, 1, 3)),
    ]


def test_history_of_an_unknown_item(market):
    assert rows(item_history(*market, "stray")) == [(None, D("3.00"), None, date(2024, 1, 1))]
    assert rows(item_history(*market, "nowhere")) == []


def test_search_statistics(market):
    got = rows(search_items(*market, "sQuAlL", "FINAL"))
    url = "https://www.tcgplayer.com/product/5"
    assert got == [
        ("Red Squall", "Final", "a", url, 3, D("1.34"), D("1.00"), D("2.00"), D("4.00"), D("4.00"), D("4.00"))
    ]


def test_items_without_prices_count_zero(market):
    got = {r["id"]: r for r in search_items(*market, None, "other").collect()}
    assert got["c"]["price_records_count"] == 0 and got["c"]["avg_price"] is None
    assert got["c"]["tcgplayer_url"] is None
    only_empty = search_items(*market, "wool").first()
    assert only_empty["price_records_count"] == 1 and only_empty["avg_price"] is None


@pytest.mark.parametrize(
    "name, set_name, expected",
    [
        (None, None, ["100% Wool", "Red Squall", "back\\slash", None]),
        ("", "", ["100% Wool", "Red Squall", "back\\slash", None]),
        ("r_d", None, ["Red Squall"]),
        ("1%wool", None, ["100% Wool"]),
        ("k\\s", None, ["back\\slash"]),
        ("nothing", None, []),
    ],
)
def test_terms(spark, market, name, set_name, expected):
    assert names(search_items(*market, name, set_name)) == expected
    prices, items = market
    prices.createOrReplaceTempView("t_prices")
    items.createOrReplaceTempView("t_items")
    register_item_search(spark, "t_prices", "t_items")
    by_sql = spark.sql("SELECT * FROM get_card_id(:n, :s)", {"n": name, "s": set_name})
    assert rows(by_sql) == rows(search_items(*market, name, set_name))


def test_limit_follows_the_order(market):
    assert names(search_items(*market, limit=2)) == ["100% Wool", "Red Squall"]


def test_repeated_item_rows_count_together(market, items):
    prices, _ = market
    twice = items({"id": "a"}, {"id": "a"})
    assert [r["price_records_count"] for r in search_items(prices, twice).collect()] == [6]


def test_history_function(spark, market):
    prices, items = market
    prices.createOrReplaceTempView("t_prices")
    items.createOrReplaceTempView("t_items")
    register_item_prices(spark, "t_prices", "t_items")
    assert rows(spark.sql("SELECT * FROM get_card_prices('a')")) == rows(item_history(prices, items, "a"))


def test_lookup_join(spark, market):
    prices, _ = market
    games = spark.createDataFrame([("a", 7)], "id STRING, game INT")
    got = lookup_join(prices, games)
    assert got.count() == 5 and {(r["id"], r["game"]) for r in got.collect()} >= {("a", 7), ("b", None)}


def test_mean_rounds_once_and_half_up(spark, prices, items):
    facts = prices(*[("a", v, None, f"2024-01-0{n}") for n, v in enumerate(("0.01", "0.02"), start=1)])
    assert search_items(facts, items({"id": "a"})).first()["avg_price"] == D("0.02")  # 0.015
