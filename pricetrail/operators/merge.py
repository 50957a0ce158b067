"""Insert-only and newer-wins merges, as joins.

Rows with a NULL in the key match nothing.  They take a path of their own, because a join
or a grouping would gather all of them in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRICE_KEY = ("id", "pull_date")
ACTION = "action"


def split_by_key(df: DataFrame, *key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is complete, and the others."""
    missing = reduce(Column.__or__, [F.col(name).isNull() for name in key])
    return df.filter(~missing), df.filter(missing)


def one_per_key(df: DataFrame, key: tuple[str, ...], *order: Column) -> DataFrame:
    """The first row of each key.

    Spark keeps one row per key in each task before the shuffle, so a key with very many
    copies does not reach one task whole.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def new_price_rows(
    target: DataFrame, source: DataFrame, prune: bool = True, keyless: bool = True
) -> DataFrame:
    """Source rows whose (id, pull_date) the target does not have; of copies, one.

    With ``prune``, only the target's partitions of dates that the source has are read.  The
    dates, at most one per day of the calendar, are a scalar subquery, so nothing runs until
    the result is used.
    ``keyless=False`` states that every source row has its key, which saves a scan.
    """
    columns = target.columns
    given = source.select(columns)
    if prune:
        dates = source.agg(F.collect_set("pull_date")).scalar()
        target = target.filter(F.array_contains(dates, F.col("pull_date")))
    keyed, unkeyed = split_by_key(given, *PRICE_KEY)
    values = [F.asc_nulls_last(name) for name in columns if name not in PRICE_KEY]
    single = one_per_key(keyed, PRICE_KEY, *values)
    fresh = single.join(target.select(*PRICE_KEY), list(PRICE_KEY), "left_anti").select(columns)
    return fresh.unionByName(unkeyed) if keyless else fresh


def merge_insert_only(
    target: DataFrame, source: DataFrame, prune: bool = True, keyless: bool = True
) -> DataFrame:
    """The target after the merge; its own rows never change."""
    return target.unionByName(new_price_rows(target, source, prune, keyless))


def newest_per_item(source: DataFrame) -> DataFrame:
    """One row per id: the latest pull_date, ties by the remaining columns."""
    rest = [F.asc_nulls_last(f"`{name}`") for name in source.columns if name not in PRICE_KEY]
    return one_per_key(source, ("id",), F.desc_nulls_last("pull_date"), *rest)


def classified_upsert(target: DataFrame, source: DataFrame) -> DataFrame:
    """The item table after the merge, with what happened to each row in ``action``.

    inserted   the id was unknown
    updated    the source row has a later pull_date and replaced the target row
    skipped    the source row has the same or an earlier date; the target row stays
    kept       no source row, or a date is missing on either side
    """
    columns = target.columns
    kept, kept_keyless = split_by_key(target, "id")
    given, given_keyless = split_by_key(source.select([f"`{c}`" for c in columns]), "id")
    old, new = kept.alias("old"), newest_per_item(given).alias("new")
    both = old.join(new, F.col("old.id") == F.col("new.id"), "full_outer")
    action = (
        F.when(F.col("old.id").isNull(), "inserted")
        .when(F.col("new.pull_date") > F.col("old.pull_date"), "updated")
        .when(F.col("new.pull_date") <= F.col("old.pull_date"), "skipped")
        .otherwise("kept")
    )
    take_new = F.col(ACTION).isin("inserted", "updated")
    merged = both.withColumn(ACTION, action).select(
        *[F.when(take_new, F.col(f"new.`{c}`")).otherwise(F.col(f"old.`{c}`")).alias(c) for c in columns],
        ACTION,
    )
    return merged.unionByName(kept_keyless.withColumn(ACTION, F.lit("kept"))).unionByName(
        given_keyless.withColumn(ACTION, F.lit("inserted"))
    )


def upsert_newer_wins(target: DataFrame, source: DataFrame) -> DataFrame:
    """The item table after the merge.

    A source row replaces its target row only if its pull_date is later; an equal, older or
    missing date keeps the target.  Unknown ids are inserted.
    """
    return classified_upsert(target, source).drop(ACTION)


def outcome_counts() -> dict[str, Column]:
    """Counts over a classified upsert.  Copies of an id in the source count once."""
    inserted, updated, skipped = (F.count_if(F.col(ACTION) == a) for a in ("inserted", "updated", "skipped"))
    return {
        "rows_inserted": inserted,
        "rows_updated": updated,
        "rows_skipped": skipped,
        "rows_merged": inserted + updated,
    }


def upsert_outcome(target: DataFrame, source: DataFrame) -> DataFrame:
    """What ``upsert_newer_wins`` does, as one row of counts."""
    counts = [count.alias(name) for name, count in outcome_counts().items()]
    return classified_upsert(target, source).agg(*counts)
