"""The operators as queries over whole tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetrail.llm import (
    decontaminate,
    lines,
    neighbours,
    packing,
    pivots,
    quality,
    secrets,
    simhash,
    substrings,
    toxicity,
    turns,
    url_rules,
    wrappers,
)
from pricetrail.llm.common import table
from pricetrail.llm.url_rules import Rule, site_rule

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Fixed values of the contract.
SITE_RULES = [
    site_rule("allow", "org/"),
    site_rule("block", "example.org/es/"),
    site_rule("block", "example.org/en/1"),
    site_rule("allow", "com/fr/"),
    site_rule("block", "com/de/"),
]
# Names that spam, gambling and adult sites put first in a host name.
FILTERS = [Rule(f"||{name}", "block") for name in ("adult-", "casino-", "cheap-pills.", "free-bets.", "spam-farm.")]


@query
def op1_url_filters(spark, sf):
    """host, path, rule and verdict of all page urls."""
    judged = url_rules.filter_urls(table(spark, sf, "pages"), SITE_RULES + FILTERS)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op2_html_extraction(spark, sf):
    """The main text of all pages."""
    return wrappers.main_text(table(spark, sf, "pages"))


@query
def op3_quality(spark, sf):
    """Quality of all documents, learnt outside the held-out fold."""
    return quality.classify_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op4_substring_dedup(spark, sf):
    """Words, removed words and digest of the kept words of all documents."""
    found = substrings.repeated_passages(table(spark, sf, "documents"), 50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op5_simhash(spark, sf):
    """doc_id, fingerprint, component_id of all documents."""
    groups = simhash.simhash_groups(table(spark, sf, "documents"), 3, 3)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op6_decontamination(spark, sf):
    """doc_id, item_id and containment of every document that holds a benchmark item."""
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op7_packing(spark, sf):
    """All pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf, "documents"))


@query
def op8_secrets(spark, sf):
    """Counts and digests of the base spans of all documents, all spans, and what ownership says of them."""
    found = secrets.find_secrets(table(spark, sf, "documents"))
    ranks = F.transform("base", lambda s: s["rank"])

    def count(rank: int):
        return F.size(F.filter(ranks, lambda r: r == rank)).cast("long")

    return found.select(
        "doc_id",
        *[count(rank).alias(f"n_{kind}") for rank, kind in enumerate(secrets.BASE_KINDS)],
        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        "n_copied",
    )


@query
def op9_toxicity(spark, sf):
    """Toxicity of all documents, learnt outside the held-out fold."""
    return toxicity.classify_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op10_embedding_dedup(spark, sf):
    """Links, component and whether it stays, of all vectors at a cosine of 0.9."""
    return neighbours.near_vectors(table(spark, sf, "embeddings"))


@query
def op11_line_dedup(spark, sf):
    """Lines, dropped lines and digest of the rest of all documents: 40 code points, five documents."""
    found = lines.without_repeated_lines(table(spark, sf, "documents"), 40, 5)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op12_conversation_trie(spark, sf):
    """All prefixes of all rebuilt conversations."""
    return turns.conversation_trie(table(spark, sf, "conversations"))


@query
def op13_centroids(spark, sf):
    """Cluster, distance, inertia and centroid of all vectors of 64 components."""
    found = pivots.with_inertia(pivots.cluster_vectors(table(spark, sf, "embeddings")))
    digest = F.sha2(F.array_join("centroid", ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


from pricetrail.llm.oracle import ORACLE  # noqa: E402, F401
