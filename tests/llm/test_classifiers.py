from __future__ import annotations

import random

import numpy as np
import pytest

from pricetrail.llm import quality, queries, toxicity
from pricetrail.llm.common import crc32_fold
from pricetrail.llm.training import Sample, labelled_sample

INSULTS = ("stupid", "idiot", "moron", "loser")


def plain_kernel(s, t, order=toxicity.ORDER, decay=toxicity.DECAY):
    """All subsequences, one by one."""
    from itertools import combinations

    def weights(x):
        out = {}
        for at in combinations(range(len(x)), order):
            key = "".join(x[i] for i in at)
            out[key] = out.get(key, 0.0) + decay ** (at[-1] - at[0] + 1)
        return out

    a, b = weights(s), weights(t)
    return sum(v * b.get(k, 0.0) for k, v in a.items())


@pytest.mark.parametrize("s, t", [("idiot", "idiot"), ("idxiot", "idiot"), ("stupid", "idiot"), ("aaaaaa", "aaaa"),
                                  ("morons", "moron"), ("abc", "abcd")])
def test_kernel_against_enumeration(s, t):
    got = toxicity.kernel(toxicity.encoded([s]), toxicity.encoded([t])[0][: len(t)])[0]
    assert got == pytest.approx(plain_kernel(s, t))


def toxic_sample(prose, n=120):
    rng = random.Random(3)
    clean = [". ".join(prose(i * 10 + k, 12) for k in range(4)) for i in range(n)]
    toxic = []
    for i in range(n // 2):
        parts = [prose(9000 + i * 10 + k, 12) for k in range(3)]
        parts.insert(rng.randrange(4), f"{prose(i, 3)} {rng.choice(INSULTS)} {prose(i + 1, 3)}")
        toxic.append(". ".join(parts))
    return Sample({0: clean, 1: toxic}, {0: n, 1: n // 2})


def test_toxicity_tolerates_gaps(prose):
    import pandas as pd

    model = toxicity.fit_toxicity(toxic_sample(prose))
    assert set(INSULTS) <= set(model.landmarks.words)
    hidden = ["st.u.p.i.d", "stuxpid", "i d i o t", "idiioot", "M-o-r-o-n", "lo*ser"]
    texts = [f"{prose(77, 300)}. You are {h} here. {prose(78, 300)}" for h in hidden]
    assert (model.scores(pd.Series(texts)) >= 0.5).all()
    clean = pd.Series([prose(5000 + i, 40) for i in range(200)] + [None, "", " ", "x" * 200_000])
    assert (model.scores(clean) < 0.5).all()


def test_toxicity_without_both_classes(prose):
    import pandas as pd

    for texts in ({0: [], 1: []}, {0: [prose(1)], 1: []}):
        model = toxicity.fit_toxicity(Sample(texts, {k: len(v) for k, v in texts.items()}))
        scores = model.scores(pd.Series([prose(2), None]))
        assert ((0 <= scores) & (scores <= 1)).all()


def quality_sample(prose, n=80):
    good = [f"{prose(i, 40)}." for i in range(n)]
    bad = ["%%% ".join(prose(900 + i, 40).split()) for i in range(n // 2)]
    return Sample({0: bad, 1: good}, {0: n // 2, 1: n})


def test_network_gradient(prose):
    net = quality.fit_quality(Sample({0: ["a"], 1: ["b"]}, {0: 1, 1: 1}), seed=1)
    data = np.frombuffer(prose(1, 200).encode(), np.uint8)
    params = [net.tables, net.bias, net.mean_weight, net.max_weight]
    grads = [np.zeros_like(p) for p in params] + [np.zeros(1, np.float32)]
    quality._gradient(net, data, 1.0, 1.0, grads)

    def loss():
        return -np.log(quality.sigmoid(net.margin(net.pooled(data))))

    rng = np.random.default_rng(0)
    for p, g in zip(params, grads, strict=False):
        for at in [tuple(rng.integers(0, s) for s in p.shape) for _ in range(3)] + [np.unravel_index(g.argmax(), g.shape)]:
            was, step = p[at], 1e-3
            p[at] = was + step
            up = loss()
            p[at] = was - step
            down = loss()
            p[at] = was
            assert (up - down) / (2 * step) == pytest.approx(g[at], abs=5e-3)


def test_network_reads_whole_texts(prose):
    import pandas as pd

    net = quality.fit_quality(quality_sample(prose))
    good, bad = prose(5000, 60) + ".", "%%% ".join(prose(6000, 60).split())
    scores = net.scores(pd.Series([good, bad, None, "", "é", prose(7000, 30_000)]))
    assert scores[0] > 0.5 > scores[1] and ((0 <= scores) & (scores <= 1)).all() and scores[5] > 0.5
    # A window is found wherever it stands, also over the border of chunks and of slices.
    data = np.frombuffer(prose(1, 400).encode(), np.uint8)
    whole = net.responses(data)
    parts = net.pooled(data)
    assert np.allclose(whole.max(axis=0), parts.max(axis=0))
    assert len(parts) == -(-len(whole) // quality.CHUNK)


@pytest.mark.parametrize("query, label, least", [("op3_quality", "quality", 0.85), ("op9_toxicity", "toxic", 0.8)])
def test_held_out_accuracy(spark, query, label, least):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.QUERIES[query](spark, sf).collect()}
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (crc32_fold(i) == 0) and 0 <= r.score <= 1 for i, r in rows.items())
    own = [rows[i].predicted == v for i, v in known.items() if i in rows and rows[i].held_out]
    assert sum(own) / len(own) >= least


def test_sample_is_bounded_and_leaves_the_fold_out(docs, labels, prose):
    frame = docs(*[(i, prose(i, 20)) for i in range(100)], (200, "x" * 50_000), (201, None))
    known = labels(*[(i, i % 2, 0) for i in range(100)], (200, 1, 0), (201, 1, 0), (3, 0, 0), (None, 1, 1), (5, None, None))
    sample = labelled_sample(frame, known, "quality", rows_per_class=10)
    assert [len(sample.texts[v]) for v in (0, 1)] == [10, 10]
    kept = {prose(i, 20): i for i in range(100)}
    assert all(crc32_fold(kept[t]) and kept[t] % 2 == v and kept[t] != 3 for v in (0, 1) for t in sample.texts[v])


def test_odd_rows(docs, labels, prose):
    frame = docs((1, None), (1, ""), (None, "text"), (2, prose(1, 20_000)), (2, prose(1, 20_000)))
    for classify in (quality.classify_quality, toxicity.classify_toxicity):
        for known in (labels(), labels((1, 1, 1), (2, 0, 0), (2, 1, 0), (None, None, None))):
            rows = classify(frame, known).collect()
            assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert classify(docs(), labels()).collect() == []
    kept = toxicity.without_toxic(frame, labels())
    assert kept.schema == frame.schema and kept.count() == 5


def test_rare_and_short_insults_of_a_skewed_lexicon(prose):
    """One insult is in half of the toxic texts, others in a few of a hundred, one has three letters."""
    import pandas as pd

    often = {"moron": 50, "vulgarian": 16, "scoundrel": 14, "dimwit": 12, "zug": 8}
    words = [w for w, n in often.items() for _ in range(4 * n)]
    clean = [". ".join(prose(i * 10 + k, 12) for k in range(4)) for i in range(800)]
    toxic = [f"{prose(9000 + i, 12)}. {prose(i, 3)} {w} {prose(i + 1, 3)}. {prose(7000 + i, 12)}" for i, w in enumerate(words)]
    model = toxicity.fit_toxicity(Sample({0: clean, 1: toxic}, {0: 800, 1: len(toxic)}))
    assert set(model.landmarks.words) == set(often)
    hidden = ["moron", "vulgarian", "scoundxrel", "dim-wit", "zug", "z.u.g", "a\nm o r o n", "i\nd i m w i t"]
    texts = pd.Series([f"{prose(77, 40)}. You are {h} here. {prose(78, 40)}" for h in hidden])
    assert (model.scores(texts) >= 0.5).all()
    assert (model.scores(pd.Series([prose(5000 + i, 40) for i in range(200)] + ["zu", "zugg", "gzu"])) < 0.5).all()


def test_letters_of_two_sentences_are_not_joined():
    assert toxicity.units_of("you a\ni d i o t")[-1] == "idiot"


def test_kernels_and_scores_are_those_of_single_words_and_texts(prose):
    """Bit for bit, whatever stands beside them in a batch or was remembered before."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeé"), rng.integers(1, 25))) for _ in range(300)]
    s = toxicity.encoded(words)
    code = toxicity.encoded(["abcdea"])[0][:6]
    both = toxicity.kernel(s, s), toxicity.kernel(s, code)
    for i in range(0, 300, 17):
        one = s[i : i + 1]
        assert (toxicity.kernel(one, one)[0], toxicity.kernel(one, code)[0]) == (both[0][i], both[1][i])
    toxic = [f"{prose(i, 20)} you moron. {prose(i + 1, 20)}" for i in range(40)]
    model = toxicity.fit_toxicity(Sample({0: [prose(800 + i, 40) for i in range(60)], 1: toxic}, {0: 60, 1: 40}))
    texts = [prose(5000 + i, 60) + (" mo-ron mxoron" if i % 3 else "") for i in range(60)] + [None, "", "m o r o n"]
    known, apart = {}, []
    for text in texts:
        apart += model.score_run([text or ""], known)
    assert model.scores(texts).tolist() == apart == [model.scores([t])[0] for t in texts]


def test_words_of_near_copies_are_no_landmarks(prose):
    """A rare word of one text that twelve near copies share says nothing about toxicity."""
    copy = prose(1, 80)
    toxic = [f"{prose(i, 20)} moron {prose(i + 1, 20)}" for i in range(40)] + [f"{copy} xyzzyra {prose(70 + i, 2)}" for i in range(12)]
    model = toxicity.fit_toxicity(Sample({0: [prose(800 + i, 40) for i in range(300)], 1: toxic}, {0: 300, 1: 52}))
    assert model.landmarks.words == ["moron"]


def test_letters_that_stand_alone_are_found_as_before():
    for text in ("a b c d", "a b c", "x a b c d y", "a. b c d e", "é à ü o", "1 2 3 4 a b c d", "I a\nm o r o n s", "A B C D."):
        slow = text.lower().split()
        for sentence in toxicity._SENTENCE_END.split(text):
            slow += ["".join(run.split()) for run in toxicity._SPACED.findall(sentence.lower())]
        assert toxicity.units_of(text) == slow
