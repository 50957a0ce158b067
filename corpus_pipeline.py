"""From documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.  All but
the last return the columns of ``documents``; each result is written as Parquet below the
shared folder and read again, so a lost executor costs at most one stage's tasks.  Empty
tables, null texts and repeated rows pass through every stage as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricetrail.llm.common import stored, table
from pricetrail.llm.decontaminate import decontaminated
from pricetrail.llm.packing import pack
from pricetrail.llm.secrets import redact_secrets
from pricetrail.llm.simhash import keep_one_of_each
from pricetrail.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: three-word shingles, at most three bits."""
    return keep_one_of_each(docs, 3, 3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owner-specific credentials are replaced in the texts; widely copied examples stay."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# The classifier, the fingerprints and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
