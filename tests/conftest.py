from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pricetrail import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    return local_session(
        4,
        4,
        **{
            "spark.checkpoint.dir": str(base / "checkpoints"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.default.parallelism": "4",
        },
    )


PRICE_DDL = "id STRING, usd DECIMAL(10,2), usd_foil DECIMAL(10,2), pull_date DATE"
ITEM_DDL = (
    "id STRING, name STRING, set_name STRING, set_type STRING, released_at DATE, rarity STRING, "
    "tcgplayer_id DECIMAL(10,0)"
)


def dec(text):
    return None if text is None else Decimal(text)


def day(text):
    return None if text is None else date.fromisoformat(text)


@pytest.fixture
def prices(spark):
    """Rows of (id, usd, usd_foil, pull_date), all given as text."""

    def build(*rows):
        typed = [(i, dec(usd), dec(foil), day(on)) for i, usd, foil, on in rows]
        return spark.createDataFrame(typed, PRICE_DDL)

    return build


@pytest.fixture
def items(spark):
    """Rows given as keyword dictionaries over an ordinary item."""

    def build(*rows):
        base = {
            "name": "Plain",
            "set_name": "First",
            "set_type": "expansion",
            "released_at": "2024-09-01",
            "rarity": "rare",
            "tcgplayer_id": "5",
        }
        typed = []
        for row in rows:
            r = {**base, **row}
            typed.append(
                (r["id"], r["name"], r["set_name"], r["set_type"], day(r["released_at"]), r["rarity"],
                 dec(r["tcgplayer_id"]))
            )
        return spark.createDataFrame(typed, ITEM_DDL)

    return build


def plan_of(df) -> str:
    """The physical plan, as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return [tuple(r) for r in df.collect()]
