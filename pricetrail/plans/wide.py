"""The load of the wide item table, whose columns follow the snapshots."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetrail.operators.flatten import flatten_wide, wide_schema
from pricetrail.plans.loads import one_row
from pricetrail.schemas import ITEM_NUMBERS, RAW_WIDE
from pricetrail.session import scratch_dir
from pricetrail.sources.evolving import EvolvingTable
from pricetrail.sources.landing import path_exists, write_observed
from pricetrail.sources.snapshots import CORRUPT, is_unreadable, parse_snapshot, snapshot_fields
from pricetrail.sources.versions import ROWS_PER_GROUP

WIDTHS = ("int", "bigint", "decimal(38,0)")
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def wide_table(spark: SparkSession, base: str, rows_per_group: int = ROWS_PER_GROUP) -> EvolvingTable:
    """The wide item table; it starts with its 101 columns."""
    schema = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in wide_schema().items()))
    return EvolvingTable(spark, base, schema, rows_per_group)


def _whole(text: Column, kind: str) -> Column:
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast(kind))


def _width(text: Column) -> Column:
    """The place in ``WIDTHS`` of the narrowest type that takes a whole number; NULL for other text."""
    return F.coalesce(*[F.when(_whole(text, kind).isNotNull(), F.lit(n)) for n, kind in enumerate(WIDTHS)])


def new_fields(spark: SparkSession, path: str | list[str], layout: str = "lines", left_out: Collection[str] = ()) -> list[str]:
    """The snapshot's top-level fields that are no column yet, by name in any case; of names alike the first."""
    taken = {name.lower() for name in (*RAW_WIDE.fieldNames(), *wide_schema(), *left_out)}
    added = []
    for name in snapshot_fields(spark, path, layout):
        if name.lower() not in taken:
            taken.add(name.lower())
            added.append(name)
    return added


def load_wide(
    spark: SparkSession,
    path: str | list[str],
    table: EvolvingTable,
    day: date,
    layout: str = "lines",
    left_out: Collection[str] = (),
) -> DataFrame:
    """Merge one day's snapshot into the wide item table; returns one row of counts and a message.

    Fields that the table does not know become columns of text (nested ones as JSON, numbers as the reader spells them), but for those ``left_out``.  A
    number column becomes as wide as the whole numbers that the snapshot has for it; text that is no whole
    number loads as NULL.  The snapshot is parsed and written once; records that cannot be
    read or have no id are kept below the table's ``rejects`` and counted.
    """
    more = new_fields(spark, path, layout, left_out)
    raw_schema = T.StructType([*RAW_WIDE.fields, *[T.StructField(name, T.StringType()) for name in more]])
    parsed = parse_snapshot(spark, path, raw_schema, layout)
    lost = F.when(is_unreadable(raw_schema), F.col(CORRUPT)).alias(CORRUPT)
    parsed = parsed.select(*[F.col(f"`{name}`") for name in raw_schema.fieldNames()], lost)
    flat = flatten_wide(parsed, day, "string", [*more, CORRUPT])
    staged_path = scratch_dir(spark, "staged-wide")
    unfit = F.col("id").isNull()
    seen = write_observed(
        flat,
        lambda writer: writer.parquet(staged_path),
        rows_rejected=F.count_if(unfit),
        **{f"width_{name}": F.max(_width(F.col(name))) for name in ITEM_NUMBERS},
    )
    staged = spark.read.schema(flat.schema).parquet(staged_path)
    kept_aside = f"{table.base}/rejects/{day.isoformat()}"
    if seen["rows_rejected"] or path_exists(spark, kept_aside):
        staged.filter(unfit).write.mode("overwrite").parquet(kept_aside)
    numbers = {name: _whole(F.col(name), WIDTHS[seen[f"width_{name}"] or 0]) for name in ITEM_NUMBERS}
    outcome = table.upsert(staged.filter(~unfit).drop(CORRUPT).withColumns(numbers))
    message = (
        f"{outcome['rows_inserted']} inserted, {outcome['rows_updated']} updated, {outcome['rows_skipped']} skipped as older, "
        f"{seen['rows_rejected']} rejected"
    )
    return one_row(spark, **outcome, rows_rejected=seen["rows_rejected"], message=message)
