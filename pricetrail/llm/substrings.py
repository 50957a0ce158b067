"""Exact removal of long repeated passages by difference-cover anchors.

A difference cover modulo ``v`` holds, for every remainder, two members with that difference.
Two equal windows, wherever they start, therefore have some place among their first ``v`` words
that is a cover position in both documents; the ``WINDOW - v + 1`` words from there lie inside both.  So
it is enough to hash anchors of that length at cover positions.  Anchors that different texts
share are extended to full windows, which are compared by 128 bits, and a window counts as a
repeat where the smallest document that has it is another one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import stored, text_slices

WINDOW = 50
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)  # a perfect difference set
ROWS_AT_ONCE = 300_000
SLICE_BYTES = 1 << 20
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd; one for each half of a hash


def word_hashes(words: list[bytes], seed: int) -> np.ndarray:
    if seed == 0:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(words: np.ndarray, width: int, multiplier: int) -> np.ndarray:
    """A hash of every run of ``width`` words, equal for equal runs."""
    n = len(words) - width + 1
    if n <= 0:
        return np.array([], np.uint64)
    out = np.empty(n, np.uint64)
    step = 1 << 16
    size = min(n, step) + width
    powers = np.cumprod(np.full(size, multiplier, np.uint64))
    inverse = np.cumprod(np.full(size, pow(multiplier, -1, 1 << 64), np.uint64))
    for low in range(0, n, step):
        part = words[low : low + step + width - 1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * powers[: len(part)])])
        k = len(part) - width + 1
        out[low : low + k] = mixed((sums[width:] - sums[:-width]) * inverse[:k])
    return out


def anchors(hashes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Cover positions and the anchor hashes there."""
    every = rolling(hashes, window - PERIOD + 1, MULTIPLIERS[0])
    places = np.arange(len(every))
    places = places[np.isin(places % PERIOD, COVER)]
    return places, every[places]


def windows(words: list[bytes], shared: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Starts and both hash halves of the windows that hold one of the ``shared`` anchors."""
    first = word_hashes(words, 0)
    n = len(words) - window + 1
    places, found = anchors(first, window)
    places = places[np.isin(found, shared)]
    # A window from i holds the anchors at i .. i + PERIOD - 1.
    mark = np.zeros(n + PERIOD + 1, np.int64)
    np.add.at(mark, np.maximum(places - PERIOD + 1, 0), 1)
    np.add.at(mark, np.minimum(places + 1, n), -1)
    starts = np.flatnonzero(np.cumsum(mark[:n]) > 0)
    second = word_hashes(words, 1)
    return starts, rolling(first, window, MULTIPLIERS[0])[starts], rolling(second, window, MULTIPLIERS[1])[starts]


def _text_key(words: list[bytes]) -> tuple[str, int]:
    """The hash of the joined words, and its first half as a signed long."""
    digest = hashlib.sha256(b" ".join(words))
    return digest.hexdigest(), int.from_bytes(digest.digest()[:8], "little", signed=True)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _digest_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        n, keys = [], []
        for _, run in text_slices(frame["text"], SLICE_BYTES):
            for data in run:
                words = data.split()
                n.append(len(words))
                keys.append(_text_key(words))
        out = frame[["doc_id"]].copy()
        out["n_words"], out["sha"], out["cls"] = n, [k[0] for k in keys], [k[1] for k in keys]
        yield out


def _anchor_rows(window: int):
    """hash, cls and ``sure`` of the anchors, combined within runs of documents.

    An anchor that two texts of a run share is known to be shared: one row of it stays under its
    hash for the other runs to meet, the others are ``sure`` and go under a key of their own.
    So no hash has more rows in the shuffle than there are runs.
    """

    def combined(hashes: list[np.ndarray], texts: list[int]) -> pd.DataFrame:
        h = np.concatenate(hashes)
        c = np.repeat(np.array(texts, np.int64), [len(x) for x in hashes])
        order = np.lexsort((c, h))
        h, c = h[order], c[order]
        repeat = np.concatenate([[False], h[1:] == h[:-1]])
        key = np.where(repeat, mixed(h ^ mixed(_signed(c).view(np.uint64))), h)
        # The first row of a shared hash is sure as well, and stays under its hash.
        sure = repeat | np.concatenate([h[1:] == h[:-1], [False]])
        return pd.DataFrame({"key": _signed(key), "hash": _signed(h), "cls": c, "sure": sure})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes: list[np.ndarray] = []
        texts: dict[int, None] = {}
        rows = 0
        for frame in frames:
            for _, part in text_slices(frame["text"], SLICE_BYTES):
                for data in part:
                    words = data.split()
                    if len(words) < window:
                        continue
                    cls = _text_key(words)[1]
                    if cls in texts:
                        continue
                    hashes.append(np.unique(anchors(word_hashes(words, 0), window)[1]))
                    texts[cls] = None
                    rows += len(hashes[-1])
                    if rows >= ROWS_AT_ONCE:
                        yield combined(hashes, list(texts))
                        hashes, texts, rows = [], {}, 0
        if rows:
            yield combined(hashes, list(texts))

    return run


def _window_rows(window: int):
    """key, low, high, doc_id, cls and ``sure`` of candidate windows, combined within runs of documents.

    Of a window that several documents of a run have, only the smallest one's row has to meet
    other runs; the others are repeats already.
    """

    def combined(rows: list[tuple]) -> pd.DataFrame:
        low, high = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
        size = [len(r[0]) for r in rows]
        doc, cls = (np.repeat(np.array([r[i] for r in rows], np.int64), size) for i in (2, 3))
        order = np.lexsort((doc, high, low))
        low, high, doc, cls = low[order], high[order], doc[order], cls[order]
        same = np.concatenate([[False], (low[1:] == low[:-1]) & (high[1:] == high[:-1])])
        smallest = doc[np.maximum.accumulate(np.where(same, 0, np.arange(len(doc))))]
        sure = doc > smallest
        key = np.where(sure, mixed(low ^ mixed(_signed(doc).view(np.uint64))), low)
        return pd.DataFrame(
            {"key": _signed(key), "low": _signed(low), "high": _signed(high), "doc_id": doc, "cls": cls, "sure": sure}
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, n = [], 0
        for frame in frames:
            for doc_id, cls, text, shared in zip(*(frame[c] for c in ("doc_id", "cls", "text", "shared")), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                if len(words) < window or _text_key(words)[1] != cls:
                    continue
                _, low, high = windows(words, np.asarray(shared, np.int64).view(np.uint64), window)
                low, once = np.unique(low, return_index=True)
                rows.append((low, high[once], doc_id, cls))
                n += len(low)
                if n >= ROWS_AT_ONCE:
                    yield combined(rows)
                    rows, n = [], 0
        if n:
            yield combined(rows)

    return run


def _kept_rows(window: int):
    """doc_id, sha, n_removed and kept of documents with repeated windows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            columns = ("doc_id", "cls", "text", "shared", "repeats")
            for doc_id, cls, text, shared, repeats in zip(*(frame[c] for c in columns), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                sha, own = _text_key(words)
                if own != cls:
                    continue
                starts, low, _ = windows(words, np.asarray(shared, np.int64).view(np.uint64), window)
                starts = starts[np.isin(low, np.asarray(repeats, np.int64).view(np.uint64))]
                mark = np.zeros(len(words) + 1, np.int64)
                mark[starts] += 1
                np.add.at(mark, starts + window, -1)
                gone = np.cumsum(mark[:-1]) > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                found.append((doc_id, sha, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            yield pd.DataFrame(found, columns=["doc_id", "sha", "n_removed", "kept_sha256", "kept"])

    return run


def repeated_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, sha, n_words, n_removed, kept_sha256 and kept of every row of ``docs`` (doc_id, text).

    A word goes if a window of ``window`` words over it also starts in a document with a
    smaller id.  ``kept`` is the text that stays, its words joined by one space; it is null
    where nothing was removed.  Null and empty texts have no words; shorter texts than a
    window keep all.  Rows of one id are no source for each other; rows without id neither
    lose words nor are a source.  Further columns are ignored.
    """
    if window <= PERIOD:
        raise ValueError(f"a window needs more than {PERIOD} words")
    texts = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    known = texts.filter(F.col("doc_id").isNotNull()).withColumn("doc_id", F.col("doc_id").cast("long"))
    digests = texts.mapInPandas(_digest_rows, f"doc_id {id_type}, n_words long, sha string, cls long")
    digests = stored(digests, "digests")

    # Equal texts: all but those of the smallest id are repeats as a whole.
    first = digests.groupBy("sha", "cls").agg(F.min("doc_id").cast("long").alias("first"))
    first = stored(first, "texts")

    found = known.select("text").mapInPandas(_anchor_rows(window), "key long, hash long, cls long, sure boolean")
    by_key = Window.partitionBy("key")
    met = found.withColumn("least", F.min("cls").over(by_key)).withColumn("most", F.max("cls").over(by_key))
    hits = met.filter("sure OR least < most").select("cls", "hash").distinct()
    shared = hits.groupBy("cls").agg(F.collect_list("hash").alias("shared"))
    wanted = first.filter(F.col("first").isNotNull()).join(shared, "cls")
    wanted = stored(wanted.select(F.col("first").alias("id"), "cls", "shared"), "wanted")
    held = known.join(wanted, known["doc_id"] == wanted["id"]).select("doc_id", "cls", "text", "shared")
    held = stored(held, "held")

    kind = "key long, low long, high long, doc_id long, cls long, sure boolean"
    candidates = held.mapInPandas(_window_rows(window), kind)
    smallest = F.min("doc_id").over(Window.partitionBy("key", "high"))
    repeats = candidates.withColumn("smallest", smallest).filter("sure OR smallest < doc_id")
    repeats = repeats.groupBy("doc_id", "cls").agg(F.collect_set("low").alias("repeats"))
    repeats = stored(repeats, "repeats")
    removed = held.join(repeats, ["doc_id", "cls"]).mapInPandas(
        _kept_rows(window), "doc_id long, sha string, n_removed long, kept_sha256 string, kept string"
    )
    removed = stored(removed.dropDuplicates(["doc_id", "sha"]), "removed")

    rows = digests.join(first.select("sha", "first"), "sha").join(
        removed.select(F.col("doc_id").alias("id"), F.col("sha").alias("of"), "n_removed", "kept_sha256", "kept"),
        (F.col("doc_id") == F.col("id")) & (F.col("sha") == F.col("of")),
        "left",
    )
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= window)
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
