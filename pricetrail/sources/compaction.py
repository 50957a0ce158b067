"""Days of the curated fact with many small files, rewritten into few.

A rewritten day becomes a new generation of its own below the table's ``_compacted``.  One appended
entry makes the generations of a run current together.  Files of earlier generations stay, so a
reader in flight goes on with what it has listed; ``retired_files`` names them for the clean-up.
Readers and writers of the library go by ``open_prices`` and ``append_prices``, which know of this.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetrail.sources.landing import (
    GENERATION,
    GENERATIONS,
    Stage,
    compacted_days,
    days_folder,
    open_prices,
    path_exists,
    write_observed,
)
from pricetrail.schemas import PRICES

TARGET_BYTES = 128 << 20


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """Every data file of a curated fact: pull_date, generation (-1: the plain day folder), path, length, and ``live``."""
    roots = [root for root in (path, days_folder(path)) if path_exists(spark, root)]
    if not roots:
        return spark.createDataFrame([], "pull_date DATE, generation INT, path STRING, length LONG, live BOOLEAN")
    found = None
    for root in roots:
        files = Stage(root, PRICES).list_files(spark)
        found = files if found is None else found.unionByName(files)
    day = F.regexp_extract("path", "/pull_date=([0-9-]+)/", 1).try_cast("date")
    generation = F.coalesce(F.regexp_extract("path", f"/{GENERATION}=([0-9]+)/", 1).try_cast("int"), F.lit(-1))
    found = found.select(day.alias("pull_date"), generation.alias("generation"), "path", "length")
    current = F.coalesce(compacted_days(spark, path).column(F.col("pull_date")), F.lit(0))
    # A day that was never compacted has its plain folder and, of later appends, generation 0.
    live = F.when(current == 0, F.col("generation") <= 0).otherwise(F.col("generation") == current)
    return found.select("*", live.alias("live"))


def packed_days(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Per day the number of live files, and of bins of ``target_bytes`` that hold them.

    Files go into bins in order of size, each into the bin in which the sum of those before it ends.
    """
    in_order = Window.partitionBy("pull_date").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(in_order), F.lit(0))
    placed = files.filter("live").select("pull_date", "length", F.floor(before / target_bytes).alias("bin"))
    return placed.groupBy("pull_date").agg(
        F.count(F.lit(1)).alias("n_files"), F.count_distinct("bin").alias("n_bins"), F.sum("length").alias("length")
    )


def compact_days(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Rewrite the days whose files fit into half as many bins or fewer; returns pull_date and both numbers.

    A repeat finds no such day and writes nothing.  Rows do not change.  One writer at a time.
    """
    files = data_files(spark, path)
    packed = packed_days(files, target_bytes)
    chosen = packed.filter(F.col("n_files") >= 2 * F.col("n_bins")).collect()  # at most the days of the calendar
    report = spark.createDataFrame(chosen, packed.schema) if chosen else packed.filter(F.lit(False))
    if not chosen:
        return report
    # Beyond every folder that is there: one may be left from a run that never made its entry.
    generation = max(0, files.agg(F.max("generation")).first()[0]) + 1
    days = [row["pull_date"] for row in chosen]
    bins = F.create_map(*[F.lit(x) for row in chosen for x in (row["pull_date"], row["n_bins"])])[F.col("pull_date")]
    rows = open_prices(spark, path).filter(F.col("pull_date").isin(days))
    # A day comes out in as many files as it has bins: each of its slots goes to one task.
    dealt = rows.withColumns({GENERATION: F.lit(generation), "slot": F.pmod(F.xxhash64("id"), bins)})
    names = [*PRICES.fieldNames(), GENERATION]
    write_observed(
        dealt.hint("rebalance", "pull_date", "slot"),
        lambda writer: writer.mode("append").partitionBy(GENERATION, "pull_date").parquet(days_folder(path)),
        names,
        rows=F.count(F.lit(1)),
    )
    entry = spark.createDataFrame([(generation, day) for day in days], GENERATIONS).coalesce(1)
    entry.write.mode("append").parquet(f"{path}/_compacted/entries")
    return report


def retired_files(spark: SparkSession, path: str) -> DataFrame:
    """Files that no reader lists any more, for the storage's clean-up."""
    return data_files(spark, path).filter("NOT live").select("pull_date", "path", "length")
