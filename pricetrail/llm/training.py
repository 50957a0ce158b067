"""A bounded sample of labelled rows, on which the classifiers are fitted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import held_out


@dataclass
class Sample:
    """Texts of both classes, and how many training labels each class has in all."""

    texts: dict[int, list[str]]
    totals: dict[int, int]

    @property
    def known_share(self) -> float:
        """The share of class 1; 0 without labels."""
        return self.totals[1] / max(1, self.totals[0] + self.totals[1])

    @property
    def positive_share(self) -> float:
        """The share of class 1, kept away from 0 and 1."""
        return (self.totals[1] + 1.0) / (self.totals[0] + self.totals[1] + 2.0)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows_per_class: int = 1500, max_bytes: int = 1 << 15
) -> Sample:
    """At most ``rows_per_class`` texts of each class, of at most ``max_bytes`` bytes each.

    They are the rows of smallest id hash outside the held-out fold, so a sample does not
    depend on partitions.  Ids whose labels contradict each other, null labels and null texts
    are left out; texts count once.  Only the sample comes to the driver; the class totals
    cover all labels.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
    known = known.filter(F.col("label") == F.col("other")).select("doc_id", "label").persist()
    totals = {0: 0, 1: 0} | {int(r["label"]): r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # Half as many again are looked up, since some have no text or a longer one.
    wanted = [
        known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class * 3 // 2)
        for value in (0, 1)
    ]
    found = docs.select("doc_id", "text").join(F.broadcast(wanted[0].union(wanted[1])), "doc_id")
    found = found.filter(F.col("text").isNotNull() & (F.octet_length("text") <= max_bytes))
    rows = sorted(found.select("label", F.xxhash64("doc_id").alias("rank"), "text").collect())
    texts = {v: list(dict.fromkeys(r["text"] for r in rows if r["label"] == v))[:rows_per_class] for v in (0, 1)}
    known.unpersist()
    return Sample(texts, totals)
