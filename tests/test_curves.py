from __future__ import annotations

import pytest

from conftest import rows
from pricetrail.operators.curves import BEFORE, launch_curve
from pricetrail.plans.views import LAUNCH_VIEWS, register_views


@pytest.fixture
def market(prices, items):
    return (
        prices(
            ("a", "1.00", "2.00", "2024-09-02"), ("b", "2.00", None, "2024-09-02"), ("c", "9.00", None, "2024-09-02"),
            ("a", None, None, "2024-09-03"), ("b", None, "5.00", "2024-09-03"),
            ("a", "7.00", None, "2024-09-01"), ("a", "8.00", None, "2024-07-18"), ("a", "6.00", None, "2024-07-17"),
            ("a", "3.00", None, "2025-06-28"), ("a", "4.00", None, "2025-06-29"),
            ("x", "5.00", None, "2024-09-02"),
            ("core", "5.00", None, "2024-09-02"), ("early", "5.00", None, "2024-07-03"),
        ),
        items(
            {"id": "a"}, {"id": "b"}, {"id": "c", "set_name": "Second", "rarity": "common"},
            {"id": "core", "set_type": "core"}, {"id": "early", "released_at": "2024-07-01"},
            {"id": "unpriced"},
        ),
    )


def test_after_launch(market):
    assert rows(launch_curve(*market)) == [
        (300, 3.0, "First"),
        (2, None, "First"),  # rows without a price keep their group
        (1, 1.5, "First"),
        (1, 9.0, "Second"),
    ]


def test_foil(market):
    got = rows(launch_curve(*market, price="usd_foil"))
    assert (2, 5.0, "First") in got and (1, 2.0, "First") in got


def test_before_launch_includes_both_ends(market):
    assert rows(launch_curve(*market, days=BEFORE)) == [(0, 7.0, "First"), (-45, 8.0, "First")]


def test_rarity_filter(market):
    assert {r[2] for r in rows(launch_curve(*market, rarities=("mythic", "rare")))} == {"First"}


def test_named_sets_by_rarity_without_floor(market):
    got = rows(launch_curve(*market, set_names=("Second", "First"), by_rarity=True, released_from=None))
    assert (1, 9.0, "Second", "common") in got
    assert (2, 2.5, "First", "rare") not in got
    assert (2, 5.0, "First", "rare") in got  # the early item, two days after its release


def test_views_answer_sql(spark, market):
    usage = spark.sql("SELECT TIMESTAMP '2025-01-01 10:00:00' AS start_time, 'w' AS warehouse_name, "
                      "CAST(1.25 AS DECIMAL(18,9)) AS credits_used")
    register_views(spark, *market, usage)
    for name in LAUNCH_VIEWS:
        assert "avg_usd" in spark.table(name).columns
    assert spark.sql("SELECT max(date_diff) FROM price_after_launch").first()[0] == 300
    assert spark.sql("SELECT count(*) FROM price_after_launch_rare_mythic").first()[0] == 3
    assert spark.sql("SELECT daily_usd FROM daily_compute_costs").first()[0] == 2.5
    assert spark.sql("SELECT day FROM rolling_compute_costs").collect() == []  # nothing that recent
    assert spark.sql("SELECT count(*) FROM get_card_prices('a')").first()[0] == 7
    assert spark.sql("SELECT count(*) FROM get_card_id('plain', NULL)").first()[0] == 6
