from __future__ import annotations

import hashlib
import random

import pytest

from pricetrail.llm import queries, substrings


def plain(texts, window=50):
    """doc_id -> words, removed words, digest of the kept; by all windows of all documents."""
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(b" ".join(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[b" ".join(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def found(frame, window=50):
    rows = substrings.repeated_passages(frame, window).collect()
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows}


def test_query_against_brute_force(spark, sf):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op4_substring_dedup(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got == plain(texts)
    assert any(removed for _, removed, _ in got.values())


def test_cover_has_every_difference():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(31))


def test_passages_of_every_shift_and_length(docs, prose):
    """Passages of 45 to 120 words at all alignments, some inside others, over several documents."""
    rng = random.Random(5)
    passages = [prose(100 + n, rng.randint(45, 120)) for n in range(6)]
    texts = {}
    for i in range(60):
        parts = [prose(1000 + i, rng.randint(1, 70))]
        for p in rng.sample(passages, 2):
            words = p.split()
            low = rng.randint(0, 10)
            parts += [" ".join(words[low:]), prose(2000 + i, rng.randint(0, 40))]
        texts[i] = " ".join(parts)
    assert found(docs(*texts.items())) == plain(texts)


def test_repetition_inside_one_document_stays(docs, prose):
    passage = prose(1, 60)
    texts = {1: f"{passage} {passage}", 2: "a " * 500, 3: "a " * 80, 4: prose(4, 49), 5: prose(4, 49)}
    assert found(docs(*texts.items())) == plain(texts)


def test_copies_and_odd_rows(docs, prose, monkeypatch):
    monkeypatch.setattr(substrings, "ROWS_AT_ONCE", 50)  # combine over many small runs
    text = prose(3, 200)
    texts = {n: text for n in range(1, 40)} | {50: None, 51: "", 52: "\t one\x0btwo", 53: text + " end", 54: prose(9, 20_000)}
    assert found(docs(*texts.items())) == plain(texts)


def test_rows_that_share_an_id_or_have_none(docs, prose):
    a, b = prose(1, 80), prose(2, 80)
    rows = substrings.repeated_passages(docs((1, a), (1, a), (1, b), (None, a), (2, f"{a} {b}"))).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in rows) == [
        ("1", 0), ("1", 0), ("1", 0), ("2", 160), ("None", 0)]


def test_empty_table_and_small_window(docs):
    assert substrings.repeated_passages(docs()).collect() == []
    with pytest.raises(ValueError):
        substrings.repeated_passages(docs(), 31)
