"""The ledger of loaded files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetrail.functions.columns import megabytes
from pricetrail.schemas import LEDGER
from pricetrail.sources.landing import Stage, open_table


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return open_table(spark, path, LEDGER)


def known_files(ledger: DataFrame, table: str) -> DataFrame:
    """Paths that a table has loaded."""
    return ledger.filter(F.col("table_name") == table).select(F.col("file_name").alias("path"))


def listed_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Path (as a stage lists it), size and time of given files; no content is read."""
    return spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")


def pending_files(
    spark: SparkSession, stage: Stage, ledger: DataFrame, table: str, modified_after: datetime | None = None
) -> DataFrame:
    """Files of a stage that the ledger does not name for this table.

    Names are compared, not rows: loaded files are never opened again.
    """
    return stage.list_files(spark, modified_after).join(known_files(ledger, table), "path", "left_anti")


def record_files(files: DataFrame, table: str, loaded_at: datetime, path: str) -> None:
    """Append loaded files to the ledger."""
    (
        files.select(
            F.lit(table).alias("table_name"),
            F.col("path").alias("file_name"),
            megabytes(F.col("length")).alias("file_mb"),
            F.lit(loaded_at).cast("timestamp").alias("load_time"),
        )
        .coalesce(1)  # one short row per new file
        .write.mode("append")
        .parquet(path)
    )


def ledger_history(ledger: DataFrame) -> DataFrame:
    """All loads, newest first."""
    return ledger.orderBy(F.desc_nulls_last("load_time"), "table_name", F.desc("file_name"))


def ledger_recent(ledger: DataFrame, table: str, since: Column) -> DataFrame:
    """Loads of one table from ``since`` on, by file name, last first."""
    recent = ledger.filter((F.col("table_name") == table) & (F.col("load_time") >= since))
    return recent.orderBy(F.desc("file_name"))
