"""Best-fit packing of token sequences by exact-complement hashing.

Only lengths matter for a packing, and there are at most ``capacity`` of them.  The corpus is
tokenized and cut into pieces in parallel; the histogram of lengths, which has one row per
length however large the corpus, is packed into patterns with multiplicities; every piece
then finds its sequence from its number among the pieces of its length.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import arrow_runs, stored, stored_by_batches

PIECES = "row long, doc_id {id}, piece int, start long, length int, ids_crc32 long"
PLACES = "row long, doc_id {id}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
SLICE_CHARS = 1 << 20


def tokenizer(name: str) -> tiktoken.Encoding:
    """The byte-level BPE of a JSON vocabulary, by the ranks of the same vocabulary: the ids are equal.

    The vocabulary's added tokens have their ids wherever their text stands.
    """
    path = public_tokenizers.path(name.replace(".json", ".tiktoken"))
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(token[how] for token in added for how in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{name}: added tokens that do not stand for their text alone")
    return tiktoken.Encoding(
        "byte_bpe",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={token["content"]: token["id"] for token in added},
    )


def cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, ids) of the pieces of one document; only the first may be shorter than ``capacity``."""
    first = len(ids) % capacity or capacity
    yield 0, ids[:first]
    for start in range(first, len(ids), capacity):
        yield start, ids[start : start + capacity]


def pieces_of(texts: DataFrame, capacity: int, vocabulary: str, end_id: int) -> DataFrame:
    """row, doc_id, piece, start, length and ids_crc32 of the pieces of ``texts`` (row, doc_id, text)."""

    kinds = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int32(), "ids_crc32": pa.int64()}
    schema = pa.schema(list(kinds.items()))

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = functools.partial(tokenizer(vocabulary).encode, allowed_special="all")
        for batch in batches:
            for first, run in arrow_runs(batch.column("text"), SLICE_CHARS):
                at, found = [], []
                for i, text in enumerate(run, first):
                    ids = np.array([*encode(text), end_id], "<u4")
                    for piece, (start, part) in enumerate(cut(ids, capacity)):
                        at.append(i)
                        found.append((piece, start, len(part), zlib.crc32(part.tobytes())))
                named = batch.select(["row", "doc_id"]).take(pa.array(at, pa.int64()))
                values = [pa.array([row[k] for row in found], field.type) for k, field in enumerate(schema)]
                yield pa.RecordBatch.from_arrays([*named.columns, *values], names=["row", "doc_id", *schema.names])

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(tokenize, PIECES.format(id=id_type))


class Plan:
    """Patterns of lengths with how often each is used, from a histogram of lengths."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.free = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.free[length] = n
        self.patterns: list[tuple[tuple[int, ...], int]] = []
        self._exact()
        self._best_fit()

    def _filling(self, gap: int, most: int) -> tuple[int, ...] | None:
        """One, two or three free lengths of at most ``most`` that add up to ``gap``."""
        if gap == 0:
            return ()
        if gap <= most and self.free[gap]:
            return (gap,)
        pair = self._pair(gap, most)
        if pair:
            return pair
        free = np.flatnonzero(self.free[: min(most, gap) + 1])
        for x in free[::-1].tolist():  # the largest of the three
            if 3 * x < gap:
                return None
            self.free[x] -= 1
            pair = self._pair(gap - x, x)
            self.free[x] += 1
            if pair:
                return (x, *pair)
        return None

    def _pair(self, gap: int, most: int) -> tuple[int, int] | None:
        """Two free lengths with this sum: every length looks up its exact complement."""
        low = max(gap - gap // 2, 1)
        high = min(most, gap - 1)
        if low > high:
            return None
        large = self.free[low : high + 1] > 0
        small = self.free[gap - high : gap - low + 1][::-1] > 0
        both = large & small
        if gap % 2 == 0 and low == gap // 2 and self.free[low] < 2:
            both[0] = False
        found = np.flatnonzero(both)
        return None if not len(found) else (low + int(found[-1]), gap - low - int(found[-1]))

    def _exact(self) -> None:
        """Combinations of up to four lengths that fill a sequence to the last token, as often as they can."""
        left = np.zeros_like(self.free)
        for length in range(self.capacity, 0, -1):
            while self.free[length]:
                self.free[length] -= 1
                rest = self._filling(self.capacity - length, length)
                self.free[length] += 1
                if rest is None:
                    left[length], self.free[length] = self.free[length], 0
                    break
                pattern = (length, *rest)
                times = min(self.free[k] // n for k, n in Counter(pattern).items())
                for k in pattern:
                    self.free[k] -= times
                self.patterns.append((pattern, int(times)))
        self.free = left

    def _best_fit(self) -> None:
        """The other pieces, longest first, each into the open sequence with the smallest gap that holds it."""
        open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
        gaps: list[int] = []

        def put(gap: int, pattern: tuple[int, ...], times: int) -> None:
            if gap not in open_:
                insort(gaps, gap)
            open_[gap][pattern] = open_[gap].get(pattern, 0) + times

        for length in range(self.capacity, 0, -1):
            n = int(self.free[length])
            while n:
                at = bisect_left(gaps, length)
                if at == len(gaps):
                    each = self.capacity // length
                    if n >= each:
                        put(self.capacity - each * length, (length,) * each, n // each)
                    if n % each:
                        put(self.capacity - n % each * length, (length,) * (n % each), 1)
                    break
                gap = gaps[at]
                pattern, times = open_[gap].popitem()
                used = min(n, times)
                if times > used:
                    open_[gap][pattern] = times - used
                if not open_[gap]:
                    del open_[gap]
                    gaps.pop(at)
                put(gap - length, (*pattern, length), used)
                n -= used
        self.patterns += [(p, times) for found in open_.values() for p, times in found.items()]

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted starts of the runs of pieces, as length << 44 | number, with the number, sequence and offset of each."""
        used: Counter[int] = Counter()
        runs, first = [], 0
        for pattern, times in self.patterns:
            offset = 0
            for length in pattern:
                runs.append((length << 44 | used[length], used[length], first, offset))
                used[length] += times
                offset += length
            first += times
        if not runs:
            runs = [(0, 0, 0, 0)]
        return tuple(np.array(x, np.int64) for x in zip(*sorted(runs), strict=True))


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    vocabulary: str = "byte_bpe_50k.json",
    end_id: int = 0,
) -> DataFrame:
    """The pieces of all rows of ``docs`` (doc_id, text), each with its sequence and its place there.

    A row's ids are those of its text and ``end_id``; null and empty texts have ``end_id`` alone.
    Only rows of more than ``capacity`` ids are cut.  Rows that repeat are packed each; a null id
    stays null.  ``sequence_id`` counts from 0; in a sequence the pieces follow without gap from
    offset 0.  Further columns are ignored.  An empty table gives an empty result.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    tokenized = pieces_of(texts, capacity, vocabulary, end_id)
    pieces = stored_by_batches(tokenized.withColumn("part", F.spark_partition_id()), "pieces")
    per_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    per_part = stored(per_part, "lengths")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    starts, numbers, firsts, offsets = Plan(counts, capacity).places()

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            number = frame["number"].to_numpy()
            at = np.searchsorted(starts, frame["length"].to_numpy().astype(np.int64) << 44 | number, "right") - 1
            frame["sequence_id"] = firsts[at] + number - numbers[at]
            frame["offset"] = offsets[at]
            yield frame.drop(columns="number")

    within = Window.partitionBy("part", "length").orderBy("row", "piece")
    numbered = pieces.withColumn("within", F.row_number().over(within) - 1)
    # One row per length and task: it grows with the tasks, so it is shuffled to the pieces, which lie by the same keys.
    numbered = numbered.join(per_part.select("part", "length", "before").hint("merge"), ["part", "length"])
    numbered = numbered.select(
        "row", "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("before") + F.col("within")).cast("long").alias("number"),
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return numbered.mapInPandas(place, PLACES.format(id=id_type)).drop("row")
