"""Warehouse-style loads: prices from new files, items from one day's snapshot."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetrail.operators.conform import BAD_COLUMNS, REJECT_TRACE, conform_checked, conform_traced
from pricetrail.operators.merge import PRICE_KEY, new_price_rows
from pricetrail.plans.maintained import Maintained
from pricetrail.schemas import ITEM_RENAMES, ITEMS, PRICES
from pricetrail.session import scratch_dir
from pricetrail.sources.landing import Stage, append_prices, day_path, open_prices, path_exists, write_observed
from pricetrail.sources.ledger import pending_files, read_ledger, record_files
from pricetrail.sources.versions import VersionedTable

# How Spark names the failure to read a file or its footer, or to give files one schema.
UNREADABLE = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "CANNOT_MERGE_SCHEMAS", "UNABLE_TO_INFER_SCHEMA")


def one_row(spark: SparkSession, **values) -> DataFrame:
    """A report of known values."""
    columns = [
        F.lit(value).cast("bigint" if isinstance(value, int) else "string").alias(name)
        for name, value in values.items()
    ]
    return spark.range(1).select(columns)


def stage_prices(spark: SparkSession, landed: DataFrame) -> tuple[DataFrame, int]:
    """Landing rows checked and written once: the checked rows, and how many are unfit to load.

    Everything after this reads the written rows, however often it needs them.
    """
    path = scratch_dir(spark, "staged")
    checked = conform_traced(landed, PRICES, required=PRICE_KEY)
    unfit = F.count_if(F.size(BAD_COLUMNS) > 0)
    bad = write_observed(checked, lambda writer: writer.parquet(path), bad=unfit)["bad"]
    return spark.read.schema(checked.schema).parquet(path), bad


def merge_staged(
    spark: SparkSession, staged: DataFrame, target_path: str, rejects_path: str, maintained: Maintained | None = None
) -> int:
    """Append what is new in checked rows to the curated fact; returns the number appended.

    With ``maintained``, the states that follow the fact take the new rows in as well.
    """
    if maintained:
        maintained.recover()
    fit = F.size(BAD_COLUMNS) == 0
    staged.filter(~fit).write.mode("overwrite").parquet(rejects_path)
    clean = staged.filter(fit).drop(BAD_COLUMNS, *[field.name for field in REJECT_TRACE])
    fresh = new_price_rows(open_prices(spark, target_path), clean, keyless=False)
    return maintained.append(fresh) if maintained else append_prices(fresh, target_path)


def merge_prices(
    spark: SparkSession,
    landed: DataFrame,
    target_path: str,
    rejects_path: str | None = None,
    maintained: Maintained | None = None,
) -> dict[str, int]:
    """Append what is new in landing rows to the curated fact; returns rows inserted and rejected.

    Rows that do not convert, or have no id or date, go to ``rejects_path``, by default a
    hidden folder of the target.  The target is the state: a repeat after a failure finds its
    rows present and adds nothing, and it replaces the rejects.  One writer at a time.
    """
    staged, bad = stage_prices(spark, landed)
    rejects = rejects_path or f"{target_path}/_rejects/last"
    return {"rows_inserted": merge_staged(spark, staged, target_path, rejects, maintained), "rows_rejected": bad}


def _stage_files(spark: SparkSession, stage: Stage, paths: list[str]) -> tuple[list[str], list[DataFrame], int]:
    """The files that can be read, their checked rows, and how many of these are unfit.

    Values convert by row from the types that the files have.  If files do not read together,
    each half is tried by itself, down to the unreadable file: a file loads whole or not at
    all, and what fails is never looked up in an error's text.
    """
    try:
        rows, bad = stage_prices(spark, stage.read_files(spark, paths))
        return paths, [rows], bad
    except Exception as error:
        if not any(mark in str(error) for mark in UNREADABLE):
            raise
    if len(paths) == 1:
        return [], [], 0
    middle = len(paths) // 2
    first, second = (_stage_files(spark, stage, half) for half in (paths[:middle], paths[middle:]))
    return first[0] + second[0], first[1] + second[1], first[2] + second[2]


def merge_files(
    spark: SparkSession,
    stage: Stage,
    paths: list[str],
    target_path: str,
    rejects_path: str,
    maintained: Maintained | None = None,
) -> tuple[list[str], int, int]:
    """Merge files by one merge; returns those that could be read, and the rows inserted and rejected."""
    done, staged, bad = _stage_files(spark, stage, paths)
    if not done:
        return [], 0, 0
    rows = reduce(DataFrame.unionByName, staged)
    return done, merge_staged(spark, rows, target_path, rejects_path, maintained), bad


def load_prices(
    spark: SparkSession,
    stage: Stage,
    target_path: str,
    ledger_path: str,
    loaded_at: datetime,
    table: str = "prices",
    rejects_path: str | None = None,
    max_files: int = 10_000,
    modified_after: datetime | None = None,
    maintained: Maintained | None = None,
) -> DataFrame:
    """Load the files that the ledger does not know yet, continuing past bad rows and files.

    Returns one row: files loaded and failed, rows inserted and rejected, message.  The stage is
    listed once, and the pending files are a written manifest.  They load in path order in
    turns of at most ``max_files``, whose names come to the driver because the reader takes them
    there.  The ledger is written after the data, so an interrupted turn is repeated and
    the merge absorbs the repetition.  Failed files stay pending; rejected rows are kept
    below ``rejects_path``, by default in a hidden folder of the target.
    """
    manifest = scratch_dir(spark, "pending")
    pending = pending_files(spark, stage, read_ledger(spark, ledger_path), table, modified_after)
    pending.write.parquet(manifest)
    pending = spark.read.schema(pending.schema).parquet(manifest)
    base = f"{rejects_path or f'{target_path}/_rejects'}/load={loaded_at:%Y%m%dT%H%M%S}"
    loaded = failed = inserted = rejected = 0
    last = ""
    while True:
        files = pending.filter(F.col("path") > last).orderBy("path").limit(max_files).collect()
        if files:
            last = files[-1].path
            rejects = f"{base}/from={loaded + failed}"
            paths = [file.path for file in files]
            done, rows, bad = merge_files(spark, stage, paths, target_path, rejects, maintained)
            if done:
                read = set(done)
                names = [file for file in files if file.path in read]
                record_files(spark.createDataFrame(names, pending.schema), table, loaded_at, ledger_path)
            loaded, failed = loaded + len(done), failed + len(files) - len(done)
            inserted, rejected = inserted + rows, rejected + bad
        if len(files) < max_files:
            break
    message = (
        f"{loaded} new files loaded into {table}, {failed} unreadable, {inserted} rows inserted, {rejected} rejected"
    )
    return one_row(
        spark,
        table_name=table,
        files_loaded=loaded,
        files_failed=failed,
        rows_inserted=inserted,
        rows_rejected=rejected,
        message=message,
    )


def merge_item_rows(landed: DataFrame, items: VersionedTable, rejects: str = "last") -> dict:
    """Merge item rows, the later pull_date wins; returns what changed.

    The rows are checked and written once.  Those without id are kept below the table's ``rejects`` and
    counted; other values that do not convert load as NULL.
    """
    spark, path = items.spark, scratch_dir(items.spark, "staged-items")
    checked = conform_checked(landed, ITEMS, ITEM_RENAMES, required=("id",))
    unfit = F.array_contains(BAD_COLUMNS, "id")
    lost = write_observed(checked, lambda writer: writer.parquet(path), rows_rejected=F.count_if(unfit))
    staged = spark.read.schema(checked.schema).parquet(path)
    kept_aside = f"{items.base}/rejects/{rejects}"
    if lost["rows_rejected"] or path_exists(spark, kept_aside):
        staged.filter(unfit).write.mode("overwrite").parquet(kept_aside)
    return items.upsert(staged.filter(~unfit).drop(BAD_COLUMNS)) | lost


def merge_items(spark: SparkSession, stage: Stage, items: VersionedTable, day: date) -> dict:
    """Merge one day's item snapshot."""
    return merge_item_rows(stage.read_day(spark, day), items, day.isoformat())


def load_items(spark: SparkSession, stage: Stage, items: VersionedTable, day: date) -> DataFrame:
    """``merge_items`` with a report: one row of counts and a message.

    The counts come out of the merge that wrote the table.
    """
    outcome = merge_items(spark, stage, items, day)
    message = (
        f"items loaded from {day_path(stage.path, day)}: {outcome['rows_inserted']} inserted, "
        f"{outcome['rows_updated']} updated, {outcome['rows_skipped']} skipped as older, "
        f"{outcome['rows_merged']} merged, {outcome['rows_rejected']} rejected"
    )
    return one_row(spark, **outcome, message=message)
