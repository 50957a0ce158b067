from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

import pytest

from conftest import rows
from pricetrail.operators import usage
from pricetrail.schemas import USAGE


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [
            (datetime(2025, 1, 10, 23, 59), "small", D("0.0025")),
            (datetime(2025, 1, 10, 0, 0), "small", D("1.5")),
            (datetime(2025, 1, 10, 5, 0), "large", D("4")),
            (datetime(2025, 1, 11, 5, 0), "small", D("0.25")),
            (datetime(2024, 12, 1, 5, 0), "large", D("100")),
            (None, "small", D("1")),
        ],
        USAGE,
    )


def test_by_day_and_resource(log):
    got = rows(usage.cost_by_day_resource(log))
    assert got[:3] == [
        (date(2025, 1, 11), "small", D("0.25"), D("0.50")),
        (date(2025, 1, 10), "large", D("4"), D("8.00")),
        (date(2025, 1, 10), "small", D("1.5025"), D("3.01")),  # 3.005 rounds up
    ]
    assert got[-1][0] is None


def test_by_resource_and_by_day(log):
    assert rows(usage.cost_by_resource(log))[0] == ("large", D("104"), D("208.00"))
    assert rows(usage.cost_daily(log))[0] == (date(2025, 1, 11), D("0.50"), D("0.25"))


def test_rollup_counts_the_window_only(log):
    got = rows(usage.cost_rollup(log, date(2025, 1, 20)))
    assert [(r[0], r[1]) for r in got] == [("All", D("11.51")), ("2025-01-11", D("0.50")), ("2025-01-10", D("11.01"))]


def test_rollup_of_nothing(log):
    assert rows(usage.cost_rollup(log, date(2030, 1, 1))) == []


def test_newest_first(log):
    got = [r[0] for r in rows(usage.usage_recent(log))]
    assert got[0] == datetime(2025, 1, 11, 5, 0) and got[-1] is None


def test_other_rate(log):
    assert rows(usage.cost_by_resource(log, D("3")))[0][2] == D("312.00")
