"""An inverted index of three-letter runs of item names, for substring search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetrail.operators.lookup import MAX_MATCHES, search_items
from pricetrail.sources.landing import open_table

RUN = 3
BUCKETS = 64
FIELDS = ("name", "set_name")


def runs(text: Column) -> Column:
    """The distinct runs of ``RUN`` characters of a text, in lower case, as the search compares it."""
    low = F.lower(text)
    places = F.sequence(F.lit(1), F.length(low) - (RUN - 1))
    found = F.array_distinct(F.transform(places, lambda i: F.substring(low, i, F.lit(RUN))))
    return F.when(F.length(low) >= RUN, found).otherwise(F.array().cast("array<string>"))


def bucket_of(run: Column) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(BUCKETS)).cast("int")


class NameIndex:
    """Postings (field, run, id) in folders by field and bucket of the run.

    Every match is verified on the items themselves, so the index may know more than they hold: a
    new name adds postings, an old one's stay, and a repeated update after a failure does no harm.
    """

    def __init__(self, spark: SparkSession, base: str, id_type: T.DataType | None = None):
        self.spark, self.base = spark, base.rstrip("/")
        self.id = T.StructField("id", id_type or T.StringType())

    def _postings(self) -> DataFrame:
        kinds = {"run": T.StringType(), "field": T.StringType(), "bucket": T.IntegerType()}
        schema = T.StructType([self.id, *[T.StructField(name, kind) for name, kind in kinds.items()]])
        return open_table(self.spark, f"{self.base}/postings", schema)

    def update(self, items: DataFrame) -> None:
        """Add the names that the index does not know yet."""
        names = T.StructType([self.id, *[T.StructField(f, T.StringType()) for f in FIELDS]])
        given = items.select("id", *FIELDS)
        known = open_table(self.spark, f"{self.base}/indexed", names)
        same = reduce(Column.__and__, [given[c].eqNullSafe(known[c]) for c in ("id", *FIELDS)])
        fresh = given.join(known, same, "left_anti").distinct()

        def entries(field: str) -> Column:
            return F.transform(runs(F.col(field)), lambda run: F.struct(F.lit(field).alias("field"), run.alias("run")))

        each = F.explode(F.concat(*[entries(field) for field in FIELDS]))
        postings = fresh.select("id", each.alias("p")).select("id", "p.run", "p.field").distinct()
        postings = postings.withColumn("bucket", bucket_of(F.col("run")))
        dealt = postings.hint("rebalance", "field", "bucket").sortWithinPartitions("field", "bucket", "run")
        dealt.write.mode("append").partitionBy("field", "bucket").parquet(f"{self.base}/postings")
        fresh.write.mode("append").parquet(f"{self.base}/indexed")

    def _matches(self, field: str, term: str) -> DataFrame:
        """ids whose field has every run of the term; reads the term's buckets alone."""
        wanted = self.spark.range(1).select(F.explode(runs(F.lit(term))).alias("run")).select("run", bucket_of(F.col("run")))
        wanted = wanted.collect()  # the runs of one term
        own = (F.col("field") == field) & F.col("bucket").isin(sorted({r[1] for r in wanted}))
        hits = self._postings().filter(own & F.col("run").isin([r[0] for r in wanted])).select("id", "run").distinct()
        counted = hits.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        return counted.filter(F.col("n") == len(wanted)).select(F.col("id").alias("match"))

    def candidates(self, items: DataFrame, name_term: str | None, set_term: str | None) -> DataFrame:
        """The items that can match.  Terms without ``RUN`` plain characters, or with wildcards, narrow nothing down."""
        for field, term in zip(FIELDS, (name_term, set_term), strict=True):
            if term and len(term) >= RUN and not set(term) & set("%_"):
                found = self._matches(field, term)
                items = items.join(found, items["id"].eqNullSafe(found["match"]), "left_semi")
        return items

    def search(
        self, prices: DataFrame, items: DataFrame, name_term: str | None = None, set_term: str | None = None, limit: int = MAX_MATCHES
    ) -> DataFrame:
        """``search_items`` of the items that the index names."""
        return search_items(prices, self.candidates(items, name_term, set_term), name_term, set_term, limit)
