"""A second copy of the price fact for reads of single items, kept by the loads as sorted runs."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetrail.schemas import PRICES, RUN_FILES
from pricetrail.sources.landing import ROWS_PER_RANGE, open_table
from pricetrail.sources.versions import Version, Versions

SHORTEST_FILE = 250_000  # rows; a run of fewer is not split for the sake of more tasks


class CopyById(Versions):
    """The fact in runs, each ordered by (id, pull_date) over files of at most about ``rows_per_file`` rows.

    Every load adds a run.  Runs of a level, whose numbers of rows share a power of ``fanout``, become one run of a
    higher level once there are ``fanout`` of them.  So runs grow with the logarithm of the rows, and
    a row is rewritten at most once a level.  A file is sorted by one task, so a run has as many files as the cluster
    has cores where that leaves each ``SHORTEST_FILE`` rows.  The ids that each file holds are listed, so reading an item opens one
    file of a run, or the few over which a hot item spreads.

    It is a state of ``Maintained``: a version names the loads that it has, so each is taken in once.
    """

    def __init__(self, spark: SparkSession, base: str, fanout: int = 4, rows_per_file: int = ROWS_PER_RANGE):
        super().__init__(spark, base)
        if fanout < 2:
            raise ValueError("runs of a level merge from two on")
        self.fanout = fanout
        self.rows_per_file = rows_per_file

    def _read(self, paths: Iterable[str]) -> DataFrame:
        paths = list(paths)
        return self.spark.read.schema(PRICES).parquet(*paths) if paths else self.spark.createDataFrame([], PRICES)

    def current(self) -> DataFrame:
        return self._read(self.newest().parts.values())

    @staticmethod
    def _rows(parts: Iterable[str]) -> int:
        """How many rows runs have, which their names state."""
        return sum(int(part.split("-")[1]) for part in parts)

    def _level(self, rows: int) -> int:
        """The power of ``fanout`` that a run's rows reach, in whole numbers."""
        level = 0
        while rows >= self.fanout:
            rows, level = rows // self.fanout, level + 1
        return level

    def _ranges(self, rows: int) -> int:
        """The number of files of a run."""
        return max(-(-rows // self.rows_per_file), min(self.spark.sparkContext.defaultParallelism, rows // SHORTEST_FILE))

    def _write(self, rows: DataFrame, number: int) -> dict[str, str]:
        """One run of ``rows``, which are counted before they are read, and the list of its files; none of no rows."""
        n = rows.count()
        if not n:
            return {}
        path = self.new_path(number)
        ranged = rows.select(PRICES.fieldNames()).repartitionByRange(self._ranges(n), "id", "pull_date")
        ranged.sortWithinPartitions("id", "pull_date").write.parquet(path)
        files = self._read([path]).groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.min("id").alias("first_id"), F.max("id").alias("last_id")
        )
        listed = files.select(F.lit(path).alias("run"), "file", "first_id", "last_id")
        listed.coalesce(1).write.mode("append").parquet(f"{self.base}/files")  # one short row per file of the run
        return {f"{number:08d}-{n}": path}

    def apply(self, fresh: DataFrame, *loads: str) -> None:
        """Add new price rows as a run, then merge the levels that it fills."""
        old = self.newest()
        run = self._write(fresh, old.number + 1)
        self.commit(Version(old.number + 1, {**old.parts, **run}, old.rows + self._rows(run)), *loads)
        self.merge_runs()

    def full_level(self, version: Version) -> list[str]:
        """The runs of the lowest level that has ``fanout`` of them, if there is one."""
        levels: dict[int, list[str]] = {}
        for part in sorted(version.parts):
            levels.setdefault(self._level(self._rows([part])), []).append(part)
        return next((levels[level] for level in sorted(levels) if len(levels[level]) >= self.fanout), [])

    def full_levels(self, version: Version) -> list[str]:
        """``full_level`` with the levels above that its merged run would fill in turn."""
        full = self.full_level(version)
        while full:
            level = self._level(self._rows(full))
            above = [part for part in sorted(version.parts) if part not in full and self._level(self._rows([part])) == level]
            if len(above) + 1 < self.fanout:
                break
            full += above
        return full

    def merge_runs(self) -> int:
        """Merge until no level is full; returns the number of merges.  What was interrupted, the next load does."""
        merges = 0
        while True:
            old = self.newest()
            full = self.full_levels(old)
            if not full:
                return merges
            run = self._write(self._read(old.parts[part] for part in full), old.number + 1)
            kept = {part: path for part, path in old.parts.items() if part not in full}
            self.commit(Version(old.number + 1, {**kept, **run}, old.rows))
            merges += 1

    def files_of(self, item_id: str) -> list[str]:
        """The current files that may hold an item: one of each run at most, but for an item of several files."""
        listed = open_table(self.spark, f"{self.base}/files", RUN_FILES)
        near = listed.filter((F.col("first_id") <= item_id) & (F.col("last_id") >= item_id))
        runs = set(self.newest().parts.values())
        return sorted(unquote(row["file"]) for row in near.filter(F.col("run").isin(*runs)).collect()) if runs else []

    def item(self, item_id: str) -> DataFrame:
        """All prices of one item."""
        return self._read(self.files_of(item_id)).filter(F.col("id") == item_id)
