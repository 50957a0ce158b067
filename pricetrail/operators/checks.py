"""Row counts and file completeness."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetrail.functions.columns import file_name, megabytes
from pricetrail.schemas import DAY_PARTITIONS
from pricetrail.sources.landing import Stage


def day_count(prices: DataFrame, day: date) -> DataFrame:
    """Rows of one day: one row, 0 if the day is missing."""
    return prices.filter(F.col("pull_date") == F.lit(day)).agg(F.count(F.lit(1)).alias("total_count"))


def partition_files(spark: SparkSession, stages: Mapping[str, Stage]) -> DataFrame:
    """Data files of each dataset: day, name, size.  Reads listings, never content."""
    parts = DAY_PARTITIONS.fieldNames()
    listings = None
    for dataset, stage in stages.items():
        files = stage.list_files(spark).select(
            F.lit(dataset).alias("dataset"),
            F.concat_ws("-", *[F.regexp_extract("path", f"/{part}=(\\d+)/", 1) for part in parts])
            .try_cast("date")
            .alias("pull_date"),
            file_name(F.col("path")).alias("file_name"),
            "path",
            megabytes(F.col("length")).alias("size_mb"),
            "length",
        )
        listings = files if listings is None else listings.unionByName(files)
    return listings


def partition_summary(files: DataFrame) -> DataFrame:
    """Number and total size of the files per dataset and day."""
    return files.groupBy("dataset", "pull_date").agg(
        F.count(F.lit(1)).alias("n_files"), megabytes(F.sum("length")).alias("total_mb")
    )


def missing_days(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (dataset, pull_date) pairs that have no file."""
    return expected.join(files, ["dataset", "pull_date"], "left_anti")


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """Every day of a period as pull_date."""
    days = F.sequence(F.lit(first), F.lit(last))
    return spark.range(1).select(F.explode(days).alias("pull_date"))


def reconcile_days(days: DataFrame, files: DataFrame, ledger: DataFrame, landed: DataFrame, curated: DataFrame) -> DataFrame:
    """Per day of ``days``: rows landed and curated, files listed and loaded, and what that means.

    ``files`` is a listing (``partition_files`` with ``path``) of one dataset, ``ledger`` its entries,
    ``landed`` and ``curated`` its rows with a pull_date.

    missing     nothing has landed and nothing is curated
    not loaded  a landed file is not in the ledger
    short       everything is loaded, yet fewer rows are curated than landed
    complete    none of these
    """
    loaded = ledger.select(F.col("file_name").alias("path")).distinct().withColumn("loaded", F.lit(1))
    by_file = files.join(loaded, "path", "left").groupBy("pull_date").agg(
        F.count(F.lit(1)).alias("files_listed"), F.count("loaded").alias("files_loaded")
    )
    counts = [
        rows.groupBy(F.col("pull_date").cast("date").alias("pull_date")).agg(F.count(F.lit(1)).alias(name))
        for name, rows in (("landed_rows", landed), ("curated_rows", curated))
    ]
    every = days.join(by_file, "pull_date", "left")
    for count in counts:
        every = every.join(count, "pull_date", "left")
    every = every.fillna(0, ["files_listed", "files_loaded", "landed_rows", "curated_rows"])
    state = (
        F.when((F.col("files_listed") == 0) & (F.col("curated_rows") == 0), "missing")
        .when(F.col("files_loaded") < F.col("files_listed"), "not loaded")
        .when(F.col("curated_rows") < F.col("landed_rows"), "short")
        .otherwise("complete")
    )
    return every.withColumn("state", state)


def day_ranges(reconciled: DataFrame, state: str = "missing") -> DataFrame:
    """Runs of neighbouring days in one state: first_day, last_day, n_days."""
    place = F.row_number().over(Window.partitionBy("state").orderBy("pull_date"))
    runs = reconciled.filter(F.col("state") == state).select("pull_date", F.date_sub("pull_date", place).alias("run"))
    return runs.groupBy("run").agg(
        F.min("pull_date").alias("first_day"), F.max("pull_date").alias("last_day"), F.count(F.lit(1)).alias("n_days")
    ).drop("run")
