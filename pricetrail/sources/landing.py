"""Day directories, named locations, curated tables and published files."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetrail.operators.conform import ORIGIN_FILE, ORIGIN_ROW
from pricetrail.schemas import DAY_PARTITIONS, GENERATIONS, LANDING_ITEMS, LANDING_PRICES, PRICES


LIST_TASKS = 64  # a listing reads no content, so its tasks need not follow file sizes
FOLDERS_PER_TASK = 32
ROWS_PER_RANGE = 5_000_000
GENERATION = "generation"
CSV_FORM = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def day_path(base: str, day: date) -> str:
    """Directory of one day, with zero-padded month and day."""
    return f"{base.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"


def day_columns(day: Column) -> dict[str, Column]:
    """The partition values of a date column, as text."""
    return {
        "year": F.year(day).cast("string"),
        "month": F.lpad(F.month(day).cast("string"), 2, "0"),
        "day": F.lpad(F.day(day).cast("string"), 2, "0"),
    }


@dataclass(frozen=True)
class Stage:
    """A named location: where files of one kind arrive and how they read.

    ``skip_unreadable`` passes over files that cannot be read.  It also passes over the rest
    of a file when reading fails half way, for whatever reason, so it is off by default.
    """

    path: str
    schema: T.StructType
    fmt: str = "parquet"
    pattern: str = "*.parquet"
    skip_unreadable: bool = False

    def options(self) -> dict:
        return {"pathGlobFilter": self.pattern, "ignoreCorruptFiles": self.skip_unreadable}

    def reader(self, spark: SparkSession):
        return spark.read.format(self.fmt).options(**self.options())

    def read(self, spark: SparkSession) -> DataFrame:
        """All days; year, month and day are text partitions ('08' stays '08')."""
        whole = T.StructType(self.schema.fields + DAY_PARTITIONS.fields)
        return self.reader(spark).schema(whole).load(self.path)

    def read_day(self, spark: SparkSession, day: date) -> DataFrame:
        return self.reader(spark).schema(self.schema).load(day_path(self.path, day))

    def read_files(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        """Given files, under the types that they state themselves.

        A reader that is told other types may fail, or take the digits of a decimal for a
        whole number.  Files whose types differ from each other do not read together.
        Two columns say where a row is: its file, and in Parquet its number there.
        """
        files = self.reader(spark).option("mergeSchema", True).load(paths)
        row = F.col("_metadata.row_index") if self.fmt == "parquet" else F.lit(None).cast("bigint")
        own = [F.col(f"`{name}`") for name in files.columns if name.lower() not in (ORIGIN_FILE, ORIGIN_ROW)]
        return files.select(*own, F.col("_metadata.file_path").alias(ORIGIN_FILE), row.alias(ORIGIN_ROW))

    def list_files(self, spark: SparkSession, modified_after: datetime | None = None) -> DataFrame:
        """Path, size and time of each data file; no content is read.

        ``modified_after`` bounds the listing of a long history.
        """
        listing = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", self.pattern)
            .option("recursiveFileLookup", True)
        )
        if modified_after:
            listing = listing.option("modifiedAfter", f"{modified_after:%Y-%m-%dT%H:%M:%S}")
        return listing.load(self.path).select("path", "length", "modificationTime").coalesce(LIST_TASKS)


def price_stage(base: str) -> Stage:
    return Stage(base, LANDING_PRICES)


def item_stage(base: str) -> Stage:
    return Stage(base, LANDING_ITEMS)


def write_observed(
    df: DataFrame, write: Callable[[DataFrameWriter], None], columns: list[str] | None = None, **metrics: Column
) -> dict:
    """Write ``df`` and return aggregates of it, without a second pass.

    ``df`` must end in its last shuffle: the aggregates then form in the tasks that write,
    which count once however often lost executors make Spark repeat earlier stages.
    ``columns`` are the ones to write, if not all.
    """
    counter = Observation()
    seen = df.observe(counter, *[metric.alias(name) for name, metric in metrics.items()])
    write(seen.select([f"`{c}`" for c in columns or df.columns]).write)
    return counter.get


def write_counted(df: DataFrame, write: Callable[[DataFrameWriter], None]) -> int:
    return write_observed(df, write, rows=F.count(F.lit(1)))["rows"]


def write_day(df: DataFrame, base: str, day: date, compression: str = "snappy") -> int:
    """Replace one day's directory, also by nothing; returns the rows written.

    The rebalance gives files of the advisory size whatever the number of input splits;
    no single file is forced.
    """
    path = day_path(base, day)
    return write_counted(
        df.hint("rebalance"),
        lambda writer: writer.mode("overwrite").option("compression", compression).parquet(path),
    )


def write_days(df: DataFrame, base: str, date_column: str = "pull_date", compression: str = "snappy") -> int:
    """Replace each day that occurs in ``df`` and leave the others; returns the rows written.

    Rebalancing by day keeps files large, and splits a day that is much larger than others.
    """
    parts = DAY_PARTITIONS.fieldNames()
    return write_counted(
        df.withColumns(day_columns(F.col(date_column).cast("date"))).hint("rebalance", *parts),
        lambda writer: writer.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*parts)
        .parquet(base),
    )


def register_day(spark: SparkSession, table: str, stage: Stage, day: date) -> None:
    """Make one day visible in a catalog table, any number of times."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stage.schema)
    parts = ", ".join(f"{name} STRING" for name in DAY_PARTITIONS.fieldNames())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {parts}) USING {stage.fmt} "
        f"PARTITIONED BY (year, month, day) LOCATION '{stage.path}'"
    )
    spark.sql(
        f"ALTER TABLE {table} ADD IF NOT EXISTS "
        f"PARTITION (year='{day:%Y}', month='{day:%m}', day='{day:%d}') "
        f"LOCATION '{day_path(stage.path, day)}'"
    )


@contextmanager
def few_listing_tasks(spark: SparkSession, folders: int) -> Iterator[None]:
    """A reader made inside lists ``FOLDERS_PER_TASK`` folders a task; Spark by itself takes a task for each."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key, None)
    spark.conf.set(key, max(1, -(-folders // FOLDERS_PER_TASK)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def written_by_stream(spark: SparkSession, path: str) -> bool:
    """Whether a file stream keeps the list of a table's files.

    Batch readers then see only what that stream wrote, so nothing else may write there.
    """
    return path_exists(spark, f"{path}/_spark_metadata")


def open_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table of ours; empty before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def days_folder(path: str) -> str:
    """Where the generations of a fact's compacted days are."""
    return f"{path.rstrip('/')}/_compacted/days"


@dataclass(frozen=True)
class Generations:
    """The current generation of every compacted day; at most one entry per day of the calendar."""

    of: dict[date, int]

    def column(self, day: Column) -> Column:
        """The generation of a day; NULL if it was never compacted."""
        pairs = [F.lit(x) for pair in sorted(self.of.items()) for x in pair]
        return F.create_map(*pairs)[day] if pairs else F.lit(None).cast("int")


def compacted_days(spark: SparkSession, path: str) -> Generations:
    entries = f"{path.rstrip('/')}/_compacted/entries"
    if not path_exists(spark, entries):
        return Generations({})
    newest = open_table(spark, entries, GENERATIONS).groupBy("pull_date").agg(F.max("generation").alias("generation"))
    return Generations({row["pull_date"]: row["generation"] for row in newest.collect()})


def open_prices(spark: SparkSession, path: str) -> DataFrame:
    """The curated fact, for loads that merge; a file stream's own table is refused.

    Days that were compacted are read from their current generation, the others from their
    own folder; both conditions are on partition columns.
    """
    if written_by_stream(spark, path):
        raise ValueError(f"{path} belongs to a file stream; load it by append_stream only")
    plain = open_table(spark, path, PRICES)
    known = compacted_days(spark, path)
    if not known.of:
        return plain
    whole = T.StructType([*PRICES.fields, T.StructField(GENERATION, T.IntegerType())])
    current = F.coalesce(known.column(F.col("pull_date")), F.lit(0))
    days = spark.read.schema(whole).parquet(days_folder(path)).filter(F.col(GENERATION) == current).drop(GENERATION)
    return plain.filter(~F.col("pull_date").isin(sorted(known.of))).unionByName(days)


def append_prices(rows: DataFrame, path: str) -> int:
    """Append to the curated fact, partitioned by pull_date; returns the rows written.

    Once days of a table were compacted, rows go to the current generation of their day, or to generation 0.
    """
    known = compacted_days(rows.sparkSession, path)
    parts, root = ["pull_date"], path
    if known.of:
        current = F.coalesce(known.column(F.col("pull_date")), F.lit(0))
        rows, parts, root = rows.withColumn(GENERATION, current), [GENERATION, "pull_date"], days_folder(path)
    return write_counted(
        rows.hint("rebalance", "pull_date"),
        lambda writer: writer.mode("append").partitionBy(*parts).parquet(root),
    )


def write_by_id(prices: DataFrame, path: str, rows_per_range: int = ROWS_PER_RANGE) -> None:
    """A second copy of the fact, ordered by item, for one-item reads.

    The number of ranges follows the number of rows, which Parquet footers know.

    Ranges over (id, pull_date) split even an item that holds a large share of the rows,
    which buckets by id would not, and the footers of the sorted files let a reader skip
    all but a few row groups.
    """
    ranges = max(1, -(-prices.count() // rows_per_range))
    (
        prices.repartitionByRange(ranges, "id", "pull_date")
        .sortWithinPartitions("id", "pull_date")
        .write.mode("overwrite")
        .parquet(path)
    )


def latest_snapshot(rows: DataFrame, as_of: Column, date_column: str = "pull_date") -> DataFrame:
    """The rows of the newest snapshot that is not after ``as_of``.

    The date is a scalar subquery: on a partition column it prunes files at run time.
    """
    known = rows.filter(F.col(date_column) <= as_of)
    newest = known.agg(F.max(date_column)).scalar()
    return rows.filter(F.col(date_column) == newest)


def publish_csv(
    report: DataFrame, path: str, *order: Column, first: int | None = None, whole: bool = False
) -> None:
    """Replace a published CSV report (header, no index), as any CSV reader reads it.

    Quotes are doubled and blanks kept.  A sorted report is a set of part files in order; its
    ``first`` rows alone, or with ``whole`` all of it, are one file, which one task writes.
    """
    rows = report.orderBy(*order) if order else report
    if first is not None:
        rows = rows.limit(first)
    if whole:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").options(**CSV_FORM).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False) -> DataFrame:
    """A published report; with ``line_breaks`` values may hold them, and each file is one task."""
    return spark.read.schema(schema).options(**CSV_FORM).option("multiLine", line_breaks).csv(path)
