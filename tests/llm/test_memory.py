"""What Python workers keep after a task, since idle ones lie beside later stages."""

from __future__ import annotations

import re
import subprocess
import sys
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricetrail.llm import packing, simhash, toxicity
from pricetrail.llm.common import stored_by_batches
from pricetrail.llm.toxicity import Landmarks, ToxicityModel

MEASURE = """
import re
from pricetrail.llm.common import give_back
def held():
    with open("/proc/self/smaps_rollup") as file:
        return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", file.read())[1]) // 1024
first = held()
blocks = [bytearray(b"x" * 100_000) for _ in range(600)]
last = bytearray(b"x" * 100_000)
del blocks
kept = held() - first
give_back()
print(kept, held() - first)
"""

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def batch_sizes(text, *_):
    """In place of a score or a fingerprint: the bytes of the row's batch."""

    @F.arrow_udf("long")
    def size(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([texts.nbytes] * len(texts), pa.int64())

    return size(text)


@pytest.fixture
def long_docs(spark):
    """16 MB of texts in one partition; the session's setting is as before afterwards."""
    text = F.concat(F.col("id").cast("string"), F.repeat(F.lit(" word"), 800))
    yield spark.range(0, 4_000, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    assert spark.conf.get(BATCH_SETTING, None) is None


MOST = 1_200_000


def test_toxicity_gets_short_batches(long_docs, labels, monkeypatch):
    monkeypatch.setattr(toxicity, "toxicity_scores", batch_sizes)
    assert toxicity.without_toxic(long_docs, labels((0, 0, 0)), threshold=MOST).count() == 4_000


def test_fingerprints_get_short_batches(long_docs, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprints", batch_sizes)
    assert simhash.simhash_groups(long_docs).agg(F.max("fp")).first()[0] < MOST


def test_tokens_get_short_batches(long_docs, monkeypatch):
    whole = packing.arrow_runs

    def short(texts, *limits):
        if texts.nbytes >= MOST:
            raise ValueError(f"a batch of {texts.nbytes} bytes")
        return whole(texts, *limits)

    monkeypatch.setattr(packing, "arrow_runs", short)
    assert packing.pack(long_docs).select("doc_id").distinct().count() == 4_000


def test_the_limit_of_a_batch_is_restored(spark, long_docs, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprints", batch_sizes)
    spark.conf.set(BATCH_SETTING, "3m")
    try:
        simhash.simhash_groups(long_docs)
        assert spark.conf.get(BATCH_SETTING) == "3m"
        with pytest.raises(Exception, match="no such text"):
            stored_by_batches(long_docs.select(F.raise_error(F.lit("no such text"))), "failed")
        assert spark.conf.get(BATCH_SETTING) == "3m"
    finally:
        spark.conf.unset(BATCH_SETTING)


def test_freed_memory_goes_back_to_the_system():
    root = Path(__file__).resolve().parents[2]
    out = subprocess.run([sys.executable, "-c", MEASURE], cwd=root, capture_output=True, text=True, timeout=120)
    kept, left = map(int, re.findall(r"-?\d+", out.stdout))
    assert left < 20 < kept, out.stderr


def test_a_task_gives_its_memory_back_after_its_last_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(toxicity, "give_back", lambda: calls.append(1), raising=False)
    model = ToxicityModel(Landmarks(["awful"]), np.ones(1), -1.0, 1.0, 0.1)
    texts = [["an awful day", None], ["", "fine"]]
    found = []
    for batch in model.score_batches(pa.array(t, pa.string()) for t in texts):
        assert not calls
        found += batch.to_pylist()
    assert calls == [1] and found == model.scores(texts[0] + texts[1]).tolist()
