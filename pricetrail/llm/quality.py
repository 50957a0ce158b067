"""Text quality by a byte-level convolutional network in numpy.

The bytes of a text are read in overlapping chunks, so every window of ``WIDTH`` bytes lies
whole in some chunk.  Learned filters slide over each chunk, their largest response is
pooled, and the pooled responses of all chunks are combined into one probability.  A filter
over bytes is a table of 256 numbers for each place of its window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import held_out, sigmoid, text_slices
from pricetrail.llm.training import Sample, labelled_sample

FILTERS, WIDTH, CHUNK = 16, 5, 512
EPOCHS, STEPS, BATCH, RATE = 6, 400, 32, 0.02  # at least so many passes and steps
SLICE_BYTES = 1 << 18


@dataclass
class ByteNetwork:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray  # FILTERS
    mean_weight: np.ndarray  # of the mean of the chunks
    max_weight: np.ndarray  # of the largest chunk
    offset: float

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Every filter at every window; a text shorter than a window is padded with zeros."""
        n = max(1, len(data) - WIDTH + 1)
        if len(data) < WIDTH:
            data = np.concatenate([data, np.zeros(WIDTH - len(data), np.uint8)])
        out = self.tables[0].take(data[:n], axis=0)
        for w in range(1, WIDTH):
            out += self.tables[w].take(data[w : w + n], axis=0)
        return out

    def pooled(self, data: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each chunk.

        Chunks step by ``CHUNK`` windows, so they overlap by ``WIDTH - 1`` bytes.
        """
        found = []
        step = CHUNK * max(1, SLICE_BYTES // CHUNK)
        for low in range(0, max(1, len(data)), step):
            part = data[low : low + step + WIDTH - 1]
            if low and len(part) < WIDTH:
                break
            out = self.responses(part)[:step]
            found.append(np.maximum.reduceat(out, np.arange(0, len(out), CHUNK), axis=0))
        return np.concatenate(found)

    def margin(self, pooled: np.ndarray) -> float:
        active = np.tanh(pooled + self.bias)
        return float(active.mean(axis=0) @ self.mean_weight + active.max(axis=0) @ self.max_weight + self.offset)

    def scores(self, texts: pd.Series) -> np.ndarray:
        """The probability of class 1 of each whole text."""
        out = np.empty(len(texts))
        for first, run in text_slices(texts, SLICE_BYTES):
            for i, data in enumerate(run, first):
                out[i] = self.margin(self.pooled(np.frombuffer(data, np.uint8)))
        return sigmoid(out)


def _gradient(net: ByteNetwork, data: np.ndarray, label: float, weight: float, grads: list[np.ndarray]) -> None:
    """Add one text's gradient: the pooled maximum passes it to one window per filter and chunk."""
    out = net.responses(data)
    starts = np.arange(0, len(out), CHUNK)
    n, f = len(starts), np.arange(FILTERS)
    at = np.array([low + out[low : low + CHUNK].argmax(axis=0) for low in starts])
    active = np.tanh(out[at, f] + net.bias)
    mean, best = active.mean(axis=0), active.argmax(axis=0)
    top = active[best, f]
    p = sigmoid(mean @ net.mean_weight + top @ net.max_weight + net.offset)
    d = weight * (p - label)
    grads[2] += d * mean
    grads[3] += d * top
    grads[4] += d
    back = np.repeat((d / n * net.mean_weight)[None, :], n, axis=0)
    back[best, f] += d * net.max_weight
    back *= 1 - active**2
    grads[1] += back.sum(axis=0)
    padded = np.concatenate([data, np.zeros(max(0, WIDTH - len(data)), np.uint8)])
    for w in range(WIDTH):
        np.add.at(grads[0][w], (padded[at + w], np.broadcast_to(f, at.shape)), back)


def fit_quality(sample: Sample, seed: int = 3) -> ByteNetwork:
    """Train by Adam on a labelled sample, each class weighted by its share of all labels."""
    rng = np.random.default_rng(seed)
    net = ByteNetwork(
        rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.full(FILTERS, -1.0, np.float32),
        rng.normal(0, 0.5, FILTERS).astype(np.float32),
        rng.normal(0, 0.5, FILTERS).astype(np.float32),
        float(np.log(sample.positive_share / (1 - sample.positive_share))),
    )
    if not sample.texts[0] or not sample.texts[1]:
        net.mean_weight[:] = net.max_weight[:] = 0.0
        return net
    rows = [
        (np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8), float(v)) for v in (0, 1) for t in sample.texts[v]
    ]
    share = {1.0: sample.positive_share, 0.0: 1 - sample.positive_share}
    weight = {v: len(rows) * share[v] / len(sample.texts[int(v)]) for v in share}
    params = [net.tables, net.bias, net.mean_weight, net.max_weight, np.array([net.offset], np.float32)]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    each = -(-len(rows) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // each))
    turn, turns = 0, epochs * each
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for low in range(0, len(rows), BATCH):
            batch = order[low : low + BATCH]
            grads = [np.zeros_like(p) for p in params]
            for i in batch:
                data, label = rows[i]
                _gradient(net, data, label, weight[label] / len(batch), grads)
            turn += 1
            rate = RATE * (1 - turn / (turns + 1))
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
            net.offset = float(params[4][0])
    return net


def quality_scores(text: Column, net: ByteNetwork) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(net.scores(texts))

    return score(text)


def classify_quality(
    docs: DataFrame, labels: DataFrame, rows_per_class: int = 1000, max_bytes: int = 1 << 14, threshold: float = 0.3
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text).

    The network is fitted on at most ``rows_per_class`` labelled texts of each class, of at most
    ``max_bytes`` each, outside the held-out fold; every text is scored whole.  Null and empty
    texts are scored as one window of zero bytes.  Repeated rows and ids each give a row.
    Without labels of both classes every score is the share of class 1.
    """
    net = fit_quality(labelled_sample(docs, labels, "quality", rows_per_class, max_bytes))
    scored = docs.select("doc_id", quality_scores(F.col("text"), net).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
