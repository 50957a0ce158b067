from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{n % 997}x{n % 13}" for n in range(30_000))
# Names that the operators use themselves; a table may have them as well.
CLASHING = ("fp", "component_id", "row", "words", "hash", "spans", "doc", "live", "base", "key", "clean", "label")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def docs(spark):
    """Documents of (doc_id, text), each with a source of its own and clashing columns."""

    def build(*rows, source=None):
        extra = ", ".join(f"`{name}` STRING" for name in CLASHING)
        kind = f"doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, {extra}"
        data = [
            (i, text, "en", source or f"src{n}", len(text or ""), *["x"] * len(CLASHING))
            for n, (i, text) in enumerate(rows)
        ]
        return spark.createDataFrame(data, kind)

    return build


@pytest.fixture
def labels(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "doc_id LONG, quality INT, toxic INT")

    return build


def sentence(rng: random.Random, n: int = 12) -> str:
    parts = "the er on in re ing ea or tion st nd an ou ly".split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(2, 3))) for _ in range(n))


@pytest.fixture
def prose():
    return lambda seed, n=60: sentence(random.Random(seed), n)
