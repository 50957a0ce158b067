"""Toxicity by a subsequence string kernel and a support vector machine over Nyström landmarks.

The kernel of two strings adds up, over all subsequences of ``ORDER`` characters that they
share, a weight that decays with the stretch that each occurrence covers.  A character put
into an insult only stretches some of its subsequences, so the kernel stays high.  Landmarks
are words that the labels set apart; a sentence is mapped to its kernels with them, whitened
by the landmarks' own kernel matrix (Nyström), and a linear machine is trained on labelled
sentences.  A text is as toxic as its worst sentence.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import arrow_runs, give_back, held_out, sigmoid, stored_by_batches, text_runs
from pricetrail.llm.training import Sample, labelled_sample

ORDER, DECAY = 4, 0.8
LONGEST = 24  # letters of a unit; longer ones are read in overlapping windows
FLOOR = 0.32  # kernels below count as none
COVERED = 0.5  # a word with such a kernel with a landmark is no further landmark
CHANCE = 0.01  # words that pass the landmarks' test by chance alone, over the whole vocabulary
KNOWN_UNITS = 200_000  # units remembered in a task
AT_ONCE = 10_000
SLICE_CHARS = 1 << 20
SKETCH = 64  # hashes of a text's five-word runs, by which copies in the sample are told
FOUR_ALONE = b"\x01" * 4

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_]\s+){3,}[^\W\d_](?!\S)")


def units_of(text: str) -> list[str]:
    """Lower-cased tokens; letters that stand alone, four or more in a row of one sentence, are one token."""
    tokens = text.lower().split()
    if FOUR_ALONE in bytes(map((1).__eq__, map(len, tokens))):
        for sentence in _SENTENCE_END.split(text):
            tokens += ["".join(run.split()) for run in _SPACED.findall(sentence.lower())]
    return tokens


def _letters(token: str) -> list[str]:
    """The letters of a token, in windows of at most ``LONGEST``."""
    word = token if token.isalpha() else _NOT_LETTERS.sub("", token)
    if not word:
        return []
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def encoded(words: list[str]) -> np.ndarray:
    return np.array(words, f"U{LONGEST}").view(np.int32).reshape(len(words), LONGEST)


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The gap-weighted subsequence kernel of each row of ``s`` with ``t``, or with the same row of it.

    Rows go longest first, so that a letter's step takes in just the words that have one there.
    """
    length = (s != 0).sum(axis=1)
    order = np.argsort(-length, kind="stable")
    letters = np.ascontiguousarray(s[order].T)
    other = t[:, None] if t.ndim == 1 else np.ascontiguousarray(t[order].T)
    n, m = len(s), len(other)
    having = np.searchsorted(-length[order], -np.arange(s.shape[1]))  # words longer than each place
    prefix = [np.ones((m + 1, n))] + [np.zeros((m + 1, n)) for _ in range(ORDER - 1)]
    total = np.zeros(n)
    for a in range(int(length.max(initial=0))):
        k = having[a]
        same = other[:, : k if t.ndim > 1 else 1] == letters[a, :k]
        ends = DECAY**2 * (same * prefix[-1][:m, :k])
        for j in range(m):  # in this order, so that a word's sum does not depend on the words beside it
            total[:k] += ends[j]
        for i in range(ORDER - 1, 0, -1):
            steps = DECAY**2 * (same * prefix[i - 1][:m, :k])
            grown = prefix[i][:, :k]
            grown *= DECAY
            run = np.zeros(k)
            for j in range(m):
                run = DECAY * run + steps[j]
                grown[j + 1] += run
    out = np.empty(n)
    out[order] = total
    return out


@dataclass
class Landmarks:
    words: list[str]
    codes: np.ndarray = field(init=False)  # a row of letters for each, 0 after its end
    lengths: np.ndarray = field(init=False)
    norms: np.ndarray = field(init=False)
    letters: np.ndarray = field(init=False)  # all that occur, sorted
    masks: np.ndarray = field(init=False)
    needs: np.ndarray = field(init=False)  # how many bits of its mask a word must have

    def __post_init__(self):
        self.codes = encoded(self.words) if self.words else np.zeros((0, LONGEST), np.int32)
        self.lengths = (self.codes != 0).sum(axis=1)
        self.norms = np.sqrt(kernel(self.codes, self.codes))
        self.letters = np.unique(self.codes[self.codes != 0])
        self.masks = self._masks(self.codes)
        different = np.array([len(set(w)) for w in self.words], np.int64)
        self.needs = np.bitwise_count(self.masks) - (different > ORDER)

    def _masks(self, codes: np.ndarray) -> np.ndarray:
        """A bit for each letter of the landmarks that a row has; beyond 63 letters some share a bit."""
        if not len(self.letters):
            return np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        bits = np.where(self.letters[at] == codes, np.int64(1) << (at % 63), 0)
        return np.bitwise_or.reduce(bits, axis=1)

    def kernels(self, words: list[str]) -> np.ndarray:
        """Normalized kernels of words with the landmarks.

        A word that lacks more than one of a landmark's different letters (none of four) shares
        too few subsequences to reach ``FLOOR``; such pairs are not computed and count as 0.
        Landmarks shorter than ``ORDER`` have no subsequences: they are 1 for the equal word, else 0.
        The pairs of all landmarks of one length are computed together.
        """
        out = np.zeros((len(words), len(self.words)))
        for low in range(0, len(words) if self.words else 0, AT_ONCE):
            s = encoded(words[low : low + AT_ONCE])
            length, masks = (s != 0).sum(axis=1), self._masks(s)
            tried = np.empty((len(s), len(self.words)), bool)
            for j in range(len(self.words)):
                alike = length >= ORDER if self.lengths[j] >= ORDER else length == self.lengths[j]
                tried[:, j] = (np.bitwise_count(masks & self.masks[j]) >= self.needs[j]) & alike
            some = np.flatnonzero(tried.any(axis=1))
            own = np.zeros(len(s))
            own[some] = np.sqrt(kernel(s[some], s[some]))
            for n in np.unique(self.lengths):
                of_length = np.flatnonzero(self.lengths == n)
                at, which = np.nonzero(tried[:, of_length])
                which = of_length[which]
                for first in range(0, len(at), AT_ONCE):
                    i, j = at[first : first + AT_ONCE], which[first : first + AT_ONCE]
                    if n < ORDER:
                        out[low + i, j] = (s[i] == self.codes[j]).all(axis=1)
                        continue
                    k = kernel(s[i], self.codes[j, :n]) / (own[i] * self.norms[j])
                    out[low + i, j] = np.where(k >= FLOOR, k, 0.0)
        return out


def _log_tail(k: int, n: int, share: float) -> float:
    """The logarithm of the chance that ``k`` or more of ``n`` fall in a class of that share."""
    if k <= n * share:
        return 0.0
    rest = range(k, n + 1)
    ways = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in rest]
    terms = [w + i * math.log(share) + (n - i) * math.log1p(-share) for w, i in zip(ways, rest, strict=True)]
    return max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms))


def without_copies(texts: list[str]) -> list[str]:
    """The texts without those that have half of their sketched five-word runs in common with an earlier one."""
    kept: list[str] = []
    owner: dict[int, int] = {}
    for text in texts:
        words = text.split()
        runs = {zlib.crc32(" ".join(words[i : i + 5]).encode("utf-8", "replace")) for i in range(max(1, len(words) - 4))}
        sketch = sorted(runs)[:SKETCH]
        shared = Counter(owner[run] for run in sketch if run in owner)
        if shared and 2 * max(shared.values()) >= len(sketch):
            continue
        owner.update((run, len(kept)) for run in sketch if run not in owner)
        kept.append(text)
    return kept


def choose_landmarks(sample: Sample, chance: float = CHANCE) -> Landmarks:
    """The words that are in more toxic texts than chance explains, by a binomial test over the vocabulary.

    Near copies count as one text, since the test takes texts as independent.  How frequent the best word is plays no part.  A landmark scores by all words that reach
    ``FLOOR`` with it, so these together must pass as well: a word whose stem is common elsewhere does not.
    Forms of one stem get one landmark, or a few where they are far apart.
    """
    texts = {v: without_copies(sample.texts[v]) for v in (0, 1)}
    toxic, others = len(texts[1]), len(texts[0])
    if not toxic or not others:
        return Landmarks([])
    words = {v: [{w for u in units_of(text) for w in _letters(u)} for text in texts[v]] for v in (0, 1)}
    seen = {v: Counter(w for own in words[v] for w in own) for v in (0, 1)}
    limit = math.log(chance / max(1, len(seen[0].keys() | seen[1].keys())))

    def log_chance(inside: int, outside: int) -> float:
        # A word of ordinary prose differs by chance, but not fourfold.
        fourfold = inside > 1 and inside * others >= 4 * outside * toxic
        return _log_tail(inside, inside + outside, toxic / (toxic + others)) if fourfold else 0.0

    tails = {w: log_chance(c, seen[0][w]) for w, c in seen[1].items()}
    some = sorted((w for w in tails if tails[w] <= limit), key=lambda w: (tails[w], w))
    vocabulary = sorted(seen[0].keys() | seen[1].keys())
    near = Landmarks(some).kernels(vocabulary) > 0
    chosen: list[str] = []
    for j, word in enumerate(some):
        if chosen and (Landmarks([word]).kernels(chosen)[:, 0] >= COVERED).any():
            continue
        group = {vocabulary[i] for i in np.flatnonzero(near[:, j])}
        inside, outside = (sum(not group.isdisjoint(own) for own in words[v]) for v in (1, 0))
        if log_chance(inside, outside) <= limit:
            chosen.append(word)
    return Landmarks(chosen)


def _inserted(words: list[str], seed: int = 7) -> list[str]:
    """Landmarks with a letter put in at every inner place: virtual positive examples."""
    rng = np.random.default_rng(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return [w[:i] + letters[rng.integers(26)] + w[i:] for w in words for i in range(1, len(w)) if len(w) < LONGEST]


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """A linear support vector machine (squared hinge) by Newton steps; the last entry is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.diag([*[ridge] * (x.shape[1] - 1), 1e-6])

    def loss(w):
        return 0.5 * w @ keep @ w + 0.5 * (weight * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

    for _ in range(50):
        inside = y * (x @ w) < 1
        a, c = x[inside], weight[inside]
        step = np.linalg.solve(keep + (a.T * c) @ a, (a.T * c) @ y[inside]) - w
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def _slope(f: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The slope of the probability of class 1 given a margin, by Newton steps.

    Without an offset the machine's own border stays the border: it is where the probability is one half.
    """
    a = 1.0
    for _ in range(50):
        p = sigmoid(a * f)
        gradient = (weight * (p - y) * f).sum() + 1e-3 * a
        curve = (weight * p * (1 - p) * f * f).sum() + 1e-3
        a = max(0.1, a - float(np.clip(gradient / curve, -1, 1)))
    return a


@dataclass
class ToxicityModel:
    landmarks: Landmarks
    beta: np.ndarray  # of the kernels, after whitening
    bias: float
    slope: float
    base: float  # the score of a text whose words touch no landmark

    def _vectors(self, tokens: list[str]) -> dict[str, np.ndarray]:
        """Kernels of the tokens that reach ``FLOOR`` with some landmark."""
        words = [(t, w) for t in tokens for w in _letters(t)]
        if not words or not self.landmarks.words:
            return {}
        k = self.landmarks.kernels([w for _, w in words])
        found: dict[str, np.ndarray] = {}
        for i in np.flatnonzero(k.any(axis=1)).tolist():
            token = words[i][0]
            found[token] = np.maximum(found.get(token, 0.0), k[i])
        return found

    def sentence_kernels(self, text: str, vectors: dict[str, np.ndarray]) -> list[np.ndarray]:
        """For each sentence with a word near a landmark: the largest kernels of its words."""
        found = []
        for sentence in _SENTENCE_END.split(text):
            near = [vectors[u] for u in units_of(sentence) if u in vectors]
            if near:
                found.append(np.max(near, axis=0))
        return found

    def margins(self, kernels: np.ndarray) -> np.ndarray:
        return kernels @ self.beta + self.bias

    def score_run(self, texts: list[str], known: dict[str, np.ndarray | None]) -> list[float]:
        """The probability of class 1 of each whole text; ``known`` remembers the kernels of units."""
        units = [set(units_of(text)) for text in texts]
        new = [u for u in set().union(*units) if u not in known]
        if len(known) + len(new) > KNOWN_UNITS:
            known.clear()
            new = list(set().union(*units))
        known.update(dict.fromkeys(new))
        known.update(self._vectors(new))
        out = []
        for text, own in zip(texts, units, strict=True):
            vectors = {u: v for u in own if (v := known[u]) is not None}
            kernels = self.sentence_kernels(text, vectors) if vectors else []
            worst = max(self.bias, float(self.margins(np.array(kernels)).max())) if kernels else None
            out.append(self.base if worst is None else float(sigmoid(self.slope * worst)))
        return out

    def score_batches(self, batches: Iterable[pa.Array]) -> Iterator[pa.Array]:
        """The scores of each batch; the kernels of units are remembered over all of them."""
        known: dict[str, np.ndarray | None] = {}
        for texts in batches:
            runs = arrow_runs(texts, SLICE_CHARS)
            yield pa.array([s for _, run in runs for s in self.score_run(run, known)], pa.float64())
            del texts, runs
        known.clear()
        give_back()

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        known: dict[str, np.ndarray | None] = {}
        runs = text_runs(texts, SLICE_CHARS)
        return np.array([score for _, run in runs for score in self.score_run(run, known)], np.float64)


def fit_toxicity(sample: Sample) -> ToxicityModel:
    """Train on the sentences of a labelled sample; without both classes the score is the share of class 1."""
    landmarks = choose_landmarks(sample)
    model = ToxicityModel(landmarks, np.zeros(len(landmarks.words)), 0.0, 0.0, sample.known_share)
    if not landmarks.words or not sample.texts[0]:
        return model
    tokens = list({u for texts in sample.texts.values() for t in texts for u in units_of(t)})
    vectors = model._vectors(tokens)
    sentences = {v: [model.sentence_kernels(t, vectors) for t in sample.texts[v]] for v in (0, 1)}

    # A toxic text's sentence nearest to the landmarks carries its label; texts with none say
    # nothing about sentences.  All sentences of other texts are negative.
    positive = np.array([max(s, key=np.max) for s in sentences[1] if s]).reshape(-1, len(landmarks.words))
    negative = np.array([k for s in sentences[0] for k in s]).reshape(-1, len(landmarks.words))
    nothing = np.zeros((1, len(landmarks.words)))
    virtual = landmarks.kernels(_inserted(landmarks.words))
    gram = np.array([landmarks.kernels([w])[0] for w in landmarks.words])
    gram = (gram + gram.T) / 2
    value, basis = np.linalg.eigh(gram)
    whiten = basis @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ basis.T
    x = np.vstack([positive, virtual, negative, nothing])
    y = np.array([1.0] * (len(positive) + len(virtual)) + [-1.0] * (len(negative) + 1))
    share = lambda n: 1.0 / max(1, n)
    weight = np.concatenate(
        [
            np.full(len(positive), share(len(positive))),
            np.full(len(virtual), share(len(virtual))),
            np.full(len(negative), share(len(negative))),
            np.ones(1),
        ]
    )
    w = _machine(x @ whiten, y, 100 * weight)
    model.beta, model.bias = whiten @ w[:-1], float(w[-1])

    def worst(kernels: list[np.ndarray]) -> float:
        return max(model.bias, float(model.margins(np.array(kernels)).max())) if kernels else model.bias

    f = np.array([worst(s) for v in (0, 1) for s in sentences[v]])
    label = np.array([0.0] * len(sentences[0]) + [1.0] * len(sentences[1]))
    prior = np.where(label == 1, sample.positive_share / max(1, len(sentences[1])),
                     (1 - sample.positive_share) / max(1, len(sentences[0])))
    spread = np.array(model.margins(virtual))
    f = np.concatenate([f, spread])
    label = np.concatenate([label, np.ones(len(spread))])
    prior = np.concatenate([prior, np.full(len(spread), sample.positive_share / max(1, len(spread)))])
    model.slope = _slope(f, label, 1000 * prior)
    model.base = float(sigmoid(model.slope * model.bias))
    return model


def toxicity_scores(text: Column, model: ToxicityModel) -> Column:
    """The score of every text; a task remembers the kernels of units over all its batches."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return model.score_batches(batches)

    return score(text)


def classify_toxicity(
    docs: DataFrame, labels: DataFrame, rows_per_class: int = 1500, max_bytes: int = 1 << 15, threshold: float = 0.5
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text).

    The machine is fitted on at most ``rows_per_class`` labelled texts of each class, of at most
    ``max_bytes`` each, outside the held-out fold; every text is scored whole.  Null and empty
    texts have the score of a text without any landmark.  Repeated rows and ids each give a
    row.  Without labels of both classes every score is the share of class 1, without any it is 0.
    """
    model = fit_toxicity(labelled_sample(docs, labels, "toxic", rows_per_class, max_bytes))
    scored = docs.select("doc_id", toxicity_scores(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(
    docs: DataFrame, labels: DataFrame, rows_per_class: int = 1500, max_bytes: int = 1 << 15, threshold: float = 0.5
) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay.

    A score is of the text alone, so only the hashes of rejected texts are stored, not the rows that stay.
    """
    model = fit_toxicity(labelled_sample(docs, labels, "toxic", rows_per_class, max_bytes))
    low = F.col("score") < threshold
    scored = docs.select(F.sha2("text", 256).alias("__gone"), toxicity_scores(F.col("text"), model).alias("score"))
    gone = stored_by_batches(scored.filter(~low).select("__gone").distinct(), "toxic")
    return docs.join(gone, F.sha2(docs["text"], 256).eqNullSafe(gone["__gone"]), "left_anti")
