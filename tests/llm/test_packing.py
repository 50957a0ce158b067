from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pricetrail.llm import packing, queries


def check_plan(counts, capacity):
    plan = packing.Plan(counts, capacity)
    used = Counter()
    for pattern, times in plan.patterns:
        assert sum(pattern) <= capacity and times > 0
        for length in pattern:
            used[length] += times
    assert used == Counter({k: v for k, v in counts.items() if v})
    return sum(times for _, times in plan.patterns)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 30), max_size=25))
def test_plans_use_every_piece_once(counts):
    n = check_plan(counts, 40)
    total = sum(k * v for k, v in counts.items())
    assert -(-total // 40) <= n <= max(1, 2 * -(-total // 40))


@pytest.mark.parametrize(
    "counts, sequences",
    [({100: 3}, 3), ({60: 2, 40: 2}, 2), ({50: 1, 30: 1, 20: 1}, 1), ({40: 1, 30: 1, 20: 1, 10: 1}, 1),
     ({25: 4}, 1), ({70: 1, 60: 1, 40: 1, 30: 1}, 2), ({51: 4}, 4), ({}, 0)],
)
def test_exact_complements(counts, sequences):
    assert check_plan(counts, 100) == sequences


def pieces(rows):
    """doc_id -> its sorted (piece, start, length, crc)."""
    out = defaultdict(list)
    for r in rows:
        out[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    return {k: sorted(v) for k, v in out.items()}


def check_places(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@cache
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(text, capacity=2048):
    ids = np.array([*tokenizer().encode(text or "", add_special_tokens=False).ids, 0], "<u4")
    first = len(ids) % capacity or capacity
    cuts = [(0, first)] + [(i, capacity) for i in range(first, len(ids), capacity)]
    return [(n, i, k, zlib.crc32(ids[i : i + k].tobytes())) for n, (i, k) in enumerate(cuts)]


def test_query_against_the_tokenizer(spark, sf):
    rows = queries.op7_packing(spark, sf).collect()
    n = check_places(rows, 2048)
    assert n <= 1.05 * sum(r.length for r in rows) / 2048 + 1
    got = pieces(rows)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        assert got[i] == expected(text)


def test_odd_rows(docs, prose):
    long_text = prose(1, 30_000)
    rows = packing.pack(docs((1, None), (2, ""), (3, "ein Wort"), (3, "ein Wort"), (None, "x"), (5, long_text))).collect()
    check_places(rows, 2048)
    got = pieces(rows)
    assert got[1] == got[2] == [(0, 0, 1, zlib.crc32(b"\0\0\0\0"))]
    assert got[3] == expected("ein Wort") * 2 and len(got[None]) == 1
    assert got[5] == expected(long_text)


def test_empty_table(docs):
    assert packing.pack(docs()).collect() == []


def test_added_tokens_have_their_own_ids():
    """Alone, glued to words and repeated, as the contract's tokenizer has them."""
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ours = packing.tokenizer("byte_bpe_50k.json")
    end = "<|endoftext|>"
    for text in (end, f"a{end}b", f"a {end} b", end * 3, f"{end}\n{end}", f"<|endoftext|{end}", "<|endoftext|", f"é{end}😀 x"):
        assert ours.encode(text, allowed_special="all") == theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(end, allowed_special="all") == [50256]
