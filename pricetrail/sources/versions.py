"""Versions of named parts, and item tables that rewrite only the parts that a load changes."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetrail.operators.merge import classified_upsert, outcome_counts
from pricetrail.schemas import PARTS
from pricetrail.sources.landing import few_listing_tasks, open_table, write_observed

GROUP = "id_group"
ROWS_PER_GROUP = 1_000_000


@dataclass(frozen=True)
class Version:
    """One version: its number, the path of every part, how many rows all parts have, and its schema if versions may differ."""

    number: int
    parts: dict[str, str]
    rows: int
    schema: str | None = None


class Versions:
    """Which path each named part of a table has, version by version.

    A version's entry is one file with all its parts, appended after the data is complete, so
    readers see a version whole or not at all, and a failed write leaves no trace.  Paths are
    never written twice; old ones stay for readers, and ``retired`` names those that may go.
    An entry may also name the loads that made it.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def entries(self) -> DataFrame:
        return open_table(self.spark, f"{self.base}/versions", PARTS)

    def newest(self) -> Version:
        """The newest version; what comes to the driver is one row per part of it."""
        entries = self.entries()
        rows = entries.filter(F.col("version") == entries.agg(F.max("version")).scalar()).collect()
        parts = {row["part"]: row["path"] for row in rows if row["part"] is not None}
        whole = next((row for row in rows if row["part"] is None), None)
        return Version(whole["version"], parts, whole["rows"], whole["schema"]) if whole else Version(0, {}, 0)

    def new_path(self, version: int) -> str:
        return f"{self.base}/data/{version:08d}-{uuid.uuid4().hex}"

    def commit(self, version: Version, *loads: str) -> None:
        """Make a version current, which takes in ``loads``."""
        rows = [(version.number, None, None, version.rows, load, version.schema) for load in loads or (None,)]
        rows += [(version.number, part, path, None, None, None) for part, path in sorted(version.parts.items())]
        entry = self.spark.createDataFrame(rows, PARTS).coalesce(1)  # one file: all parts or none
        entry.write.mode("append").parquet(f"{self.base}/versions")

    def loads(self) -> DataFrame:
        """The loads that some version has taken in."""
        return self.entries().filter(F.col("load").isNotNull()).select("load").distinct()

    def retired(self, keep: int = 7) -> DataFrame:
        """Version, part and path of what none of the newest ``keep`` versions uses, for the storage's clean-up."""
        entries = self.entries().filter(F.col("part").isNotNull()).select("version", "part", "path")
        oldest_kept = F.coalesce(self.entries().agg(F.max("version")).scalar(), F.lit(0)) - keep + 1
        used = entries.filter(F.col("version") >= oldest_kept).select("path").distinct()
        old = entries.filter(F.col("version") < oldest_kept).join(used, "path", "left_anti")
        return old.groupBy("part", "path").agg(F.max("version").alias("version")).select("version", "part", "path").orderBy("version", "part")


class GroupedTable(Versions):
    """A Parquet table in groups of ids, of which a load rewrites only those that it changes.

    An id's group is its hash modulo the number of groups, a power of two that follows the
    number of rows; when that has doubled, the next load rewrites the table once.
    """

    key = "id"

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, rows_per_group: int = ROWS_PER_GROUP):
        super().__init__(spark, base)
        self.schema = schema
        self.rows_per_group = rows_per_group

    def stated_schema(self) -> str | None:
        """The schema that a version's entry states; here all versions have the table's."""
        return None

    def _part(self, group: int, groups: int) -> str:
        return f"{group}of{groups}"

    def _groups(self, version: Version) -> int:
        return next((int(part.split("of")[1]) for part in version.parts), 1)

    def _wanted(self, rows: int) -> int:
        """The number of groups for so many rows."""
        return 1 << max(0, -(-rows // self.rows_per_group) - 1).bit_length()

    def _group(self, groups: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(groups)).cast("int")

    def _read(self, paths: Iterable[str]) -> DataFrame:
        paths = list(paths)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        with few_listing_tasks(self.spark, len(paths)):
            return self.spark.read.schema(self.schema).parquet(*paths)

    def read_groups(self, version: Version, groups: Iterable[int]) -> DataFrame:
        parts = [self._part(g, self._groups(version)) for g in groups]
        return self._read(version.parts[part] for part in parts if part in version.parts)

    def current(self) -> DataFrame:
        return self._read(self.newest().parts.values())

    def touched(self, version: Version, rows: DataFrame) -> list[int]:
        """The groups that ``rows`` have ids of; at most the number of groups."""
        groups = self._groups(version)
        return [0] if groups == 1 else sorted(r[0] for r in rows.select(self._group(groups)).distinct().collect())

    def _write(self, rows: DataFrame, version: Version, groups: int, metrics: dict[str, Column]) -> tuple[str, dict]:
        path = self.new_path(version.number + 1)
        dealt = rows.withColumn(GROUP, self._group(groups)).hint("rebalance", GROUP)
        names = [*self.schema.fieldNames(), GROUP]
        return path, write_observed(dealt, lambda writer: writer.partitionBy(GROUP).parquet(path), names, **metrics)

    def _written(self, path: str, groups: int) -> dict[str, str]:
        """The parts that a write made; a group without rows has no folder."""
        with few_listing_tasks(self.spark, groups):
            folders = self.spark.read.schema(f"{GROUP} INT").parquet(path)
        listed = folders.distinct().collect()
        return {self._part(r[0], groups): f"{path}/{GROUP}={r[0]}" for r in listed}

    def rewrite(self, rows: DataFrame, of: Version, changed: list[int] | None, total: int | None, *loads: str, **metrics: Column) -> dict:
        """Write ``rows`` as the groups ``changed`` of the next version, or as all of it; other groups stay where they are.

        ``total`` is the number of rows of the whole next version, if known.  Returns aggregates of
        the rows, which may use columns beyond the table's own.
        """
        groups = self._groups(of)
        wanted = max(groups, self._wanted(total if total is not None else of.rows))
        if changed is not None and wanted > groups:
            raise ValueError("more groups need the whole table")
        seen_rows = {"rows": F.count(F.lit(1))}
        path, seen = self._write(rows, of, wanted, {**(metrics or {}), **seen_rows})
        kept = {} if changed is None else {p: v for p, v in of.parts.items() if int(p.split("of")[0]) not in changed}
        parts = {**kept, **self._written(path, wanted)}
        count = total if total is not None else seen["rows"]
        self.commit(Version(of.number + 1, parts, count, self.stated_schema()), *loads)
        return {name: seen[name] for name in metrics} if metrics else seen

    def replace(self, rows: DataFrame, **metrics: Column) -> dict:
        """Write ``rows``, which may derive from ``current()``, as the whole next version."""
        return self.rewrite(rows, self.newest(), None, None, **metrics)


class VersionedTable(GroupedTable):
    """An item table: one row per id, the later pull_date wins."""

    def upsert(self, rows: DataFrame) -> dict:
        """Merge rows by ``classified_upsert``; returns its counts.  ``rows`` are read up to three times.

        What changes is found on ids and dates, of the groups alone that the rows touch.  Only
        groups with a change are read whole and written; without one, no version is.
        """
        return self.merge_into(self.newest(), rows)

    def merge_into(self, old: Version, rows: DataFrame) -> dict:
        """``upsert`` into the newest version, which is ``old``."""
        groups = self._groups(old)
        touched = self.touched(old, rows)
        known = self.read_groups(old, touched)  # the folders of many groups take time to list, so they are listed once
        narrow = [part.select("id", "pull_date") for part in (known, rows)]
        counts = [count.alias(name) for name, count in outcome_counts().items()]
        by_group = classified_upsert(*narrow).groupBy(self._group(groups).alias(GROUP)).agg(*counts).collect()
        outcome = {name: sum(row[name] for row in by_group) for name in outcome_counts()}
        changed = [row[GROUP] for row in by_group if row["rows_merged"]]
        if not changed:
            return outcome
        total = old.rows + outcome["rows_inserted"]
        if self._wanted(total) > groups:
            whole = known if len(touched) == groups else self._read(old.parts.values())
            self.rewrite(classified_upsert(whole, rows), old, None, total)
        else:
            kept = known if sorted(changed) == touched else self.read_groups(old, changed)
            given = rows if len(changed) == groups else rows.filter(self._group(groups).isin(changed))
            self.rewrite(classified_upsert(kept, given), old, changed, total)
        return outcome
