"""Item statistics and launch curves kept up to date by the loads, so that reads leave the fact alone."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetrail.operators.joins import broadcast_if_small
from pricetrail.operators.maintained import (
    changed_traits,
    item_stats,
    launch_rows,
    merged_launch,
    merged_stats,
    moved_launch_rows,
    traits,
)
from pricetrail.operators.merge import new_price_rows
from pricetrail.schemas import ITEM_STATS, JOURNAL, LAUNCH_STATE, PRICES, TRAITS
from pricetrail.session import scratch_dir
from pricetrail.sources.by_id import CopyById
from pricetrail.sources.landing import append_prices, open_prices, open_table, write_observed
from pricetrail.sources.versions import GroupedTable, Version, Versions

MONTH = "of_month"
TRAITS_PART = "traits"


class ItemStats(GroupedTable):
    """Price statistics per item, in groups of ids."""

    def __init__(self, spark: SparkSession, base: str, **settings):
        super().__init__(spark, base, ITEM_STATS, **settings)

    def apply(self, fresh: DataFrame, *loads: str) -> None:
        """Add the statistics of new price rows; rewrites the groups that have such rows."""
        path = scratch_dir(self.spark, "stats")
        item_stats(fresh).write.parquet(path)
        delta = self.spark.read.schema(ITEM_STATS).parquet(path)
        old = self.newest()
        touched = self.touched(old, delta)
        kept = self.read_groups(old, touched)
        new = delta.select("id").join(kept.select("id"), "id", "left_anti").count()
        total = old.rows + new
        whole = self._wanted(total) > self._groups(old)
        merged = merged_stats(self.current() if whole else kept, delta)
        self.rewrite(merged, old, None if whole else touched, total, *loads)


class LaunchState(Versions):
    """Sums and numbers of prices by day and item traits, in parts by month, and the traits that they were made with."""

    def state(self) -> DataFrame:
        return self._read(self.newest())

    def _read(self, version: Version, months: Sequence[str] | None = None) -> DataFrame:
        wanted = [p for m, p in version.parts.items() if m != TRAITS_PART and (months is None or m in months)]
        rows = self.spark.read.schema(LAUNCH_STATE).parquet(*wanted) if wanted else None
        return rows if rows is not None else self.spark.createDataFrame([], LAUNCH_STATE)

    def _traits(self, version: Version) -> DataFrame:
        path = version.parts.get(TRAITS_PART)
        return self.spark.read.schema(TRAITS).parquet(path) if path else self.spark.createDataFrame([], TRAITS)

    def _add(self, delta: DataFrame, old: Version, *loads: str, traits_path: str | None = None) -> None:
        """The next version: the months of ``delta`` rewritten with it, other months where they are."""
        path = scratch_dir(self.spark, "launch")
        month = F.date_format("pull_date", "yyyy-MM")
        delta.write.parquet(path)
        delta = self.spark.read.schema(LAUNCH_STATE).parquet(path)
        months = [row[0] for row in delta.select(month).distinct().collect()]  # at most the months of the calendar
        parts = {m: p for m, p in old.parts.items() if m not in months}
        if months:
            new = self.new_path(old.number + 1)
            rows = merged_launch(self._read(old, months), delta).withColumn(MONTH, month).hint("rebalance", MONTH)
            rows.write.partitionBy(MONTH).parquet(new)
            written = self.spark.read.schema(f"{MONTH} STRING").parquet(new).distinct().collect()
            parts |= {row[0]: f"{new}/{MONTH}={row[0]}" for row in written}
        if traits_path:
            parts[TRAITS_PART] = traits_path
        self.commit(Version(old.number + 1, parts, 0), *loads)

    def apply(self, fresh: DataFrame, *loads: str) -> None:
        """Add new price rows under the traits that items have now; prices of unknown items wait for their item."""
        old = self.newest()
        self._add(launch_rows(fresh, self._traits(old)), old, *loads)

    def update_items(self, items: DataFrame, prices: DataFrame) -> int:
        """Take over the traits of ``items``; returns how many items changed.

        Only prices of items that changed are used of ``prices``, which must be the rows of the
        loads that this state has taken in; ``Maintained.update_items`` sees to it.
        """
        old = self.newest()
        path = scratch_dir(self.spark, "changed")
        counted = F.count(F.lit(1))
        n = write_observed(changed_traits(self._traits(old), traits(items)), lambda w: w.parquet(path), rows=counted)["rows"]
        if n:
            changed = self.spark.read.parquet(path)
            few = broadcast_if_small(changed)
            own = f"{self.new_path(old.number + 1)}-traits"
            traits(items).write.parquet(own)
            self._add(moved_launch_rows(prices, changed if few is None else few), old, traits_path=own)
        return n


class Maintained:
    """A price fact with states that follow it.

    New rows are written to a journal first, then to the fact, then into each state, whose version
    names the load.  An interrupted load is finished by ``recover``: the fact gets what it lacks, and
    a state takes in a load exactly once.
    """

    def __init__(self, spark: SparkSession, prices: str, base: str, *states: ItemStats | LaunchState | CopyById):
        self.spark, self.prices, self.base, self.states = spark, prices, base.rstrip("/"), states

    def _journal(self) -> DataFrame:
        return open_table(self.spark, f"{self.base}/journal", JOURNAL)

    def _finish(self, paths: list[str]) -> None:
        """Append what the fact lacks of journaled rows."""
        rows = self.spark.read.schema(PRICES).parquet(*paths)
        append_prices(new_price_rows(open_prices(self.spark, self.prices), rows, keyless=False), self.prices)

    def recover(self) -> int:
        """Finish interrupted loads; returns how many there were.  A new state takes in the fact as it is."""
        journal = self._journal()
        waiting: dict[tuple[str, str], list] = {}
        new = [state for state in self.states if not state.newest().number]
        for state in self.states:
            if state not in new:
                # Of the loads of an old state's fact, an interruption leaves one at most.
                for row in journal.join(state.loads(), "load", "left_anti").collect():
                    waiting.setdefault((row["load"], row["path"]), []).append(state)
        for (load, path), states in sorted(waiting.items(), key=lambda entry: entry[0]):
            self._finish([path])
            for state in states:
                state.apply(self.spark.read.schema(PRICES).parquet(path), load)
        if new:
            known = journal.collect()  # one row per load
            if known:
                self._finish([row["path"] for row in known])
            for state in new:
                state.apply(open_prices(self.spark, self.prices), "start", *[row["load"] for row in known])
        return len(waiting)

    def update_items(self, items: DataFrame) -> int:
        """Bring the launch curves up to the items' present traits; returns how many items changed."""
        self.recover()
        prices = open_prices(self.spark, self.prices)
        return max([s.update_items(items, prices) for s in self.states if isinstance(s, LaunchState)], default=0)

    def append(self, fresh: DataFrame) -> int:
        """Append rows that the fact does not have, and bring every state up to date; returns their number.

        Call ``recover`` before the rows are compared with the fact.
        """
        load = uuid.uuid4().hex
        path = f"{self.base}/journaled/{load}"
        counted = F.count(F.lit(1))
        dealt = fresh.select(PRICES.fieldNames()).hint("rebalance", "pull_date")
        n = write_observed(dealt, lambda writer: writer.parquet(path), rows=counted)["rows"]
        if n:
            entry = self.spark.createDataFrame([(load, path)], JOURNAL).coalesce(1)
            entry.write.mode("append").parquet(f"{self.base}/journal")
            rows = self.spark.read.schema(PRICES).parquet(path)
            append_prices(rows, self.prices)
            for state in self.states:
                state.apply(rows, load)
        return n

    def retired(self) -> DataFrame:
        """load and path of journaled rows that every state has taken in, for the storage's clean-up."""
        done = self._journal()
        for state in self.states:
            done = done.join(state.loads(), "load", "left_semi")
        return done
