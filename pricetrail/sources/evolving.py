"""An item table whose schema follows its loads: columns are added, and types become wider."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pricetrail.operators.conform import conform
from pricetrail.operators.merge import classified_upsert, outcome_counts
from pricetrail.sources.versions import ROWS_PER_GROUP, Version, VersionedTable

# Whole-number types by rising width, with the digits of their largest values.
WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
MOST_DIGITS = 38


def wider_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that takes every value of both without loss; text takes all simple values.

    Nested types have none but themselves.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    names = [kind.simpleString() for kind in (one, other)]
    for kind in (one, other):
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.BinaryType)):
            raise ValueError(f"no type is wider than {names[0]} and {names[1]}")
    if all(name in WHOLE_DIGITS for name in names):
        return max((one, other), key=lambda kind: WHOLE_DIGITS[kind.simpleString()])
    sizes = [
        (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else (WHOLE_DIGITS.get(name), 0)
        for kind, name in zip((one, other), names)
    ]
    if all(whole is not None for whole, _ in sizes):
        whole, scale = (max(parts) for parts in zip(*sizes))
        return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else T.StringType()
    exact_in_double = {"tinyint", "smallint", "int", "float", "double"}
    if set(names) <= exact_in_double and "double" in names:
        return T.DoubleType()
    return T.StringType()


def evolved(schema: T.StructType, given: T.StructType) -> T.StructType:
    """``schema`` with wider types where ``given`` needs them, and its further columns at the end.

    Columns are matched by name in any case.
    """
    known = {field.name.lower(): field for field in schema}
    types = {name: field.dataType for name, field in known.items()}
    added = []
    for field in given:
        name = field.name.lower()
        if name in types:
            types[name] = wider_type(types[name], field.dataType)
        else:
            types[name] = field.dataType
            added.append(field)
    return T.StructType([T.StructField(field.name, types[field.name.lower()]) for field in [*schema, *added]])


def reads_in_place(old: T.StructType, new: T.StructType) -> bool:
    """Whether files written under ``old`` read under ``new``: columns were added, whole numbers got wider."""
    types = {field.name: field.dataType for field in new}
    return all(
        types[field.name] == field.dataType
        or all(kind.simpleString() in WHOLE_DIGITS for kind in (field.dataType, types[field.name]))
        for field in old
    )


class EvolvingTable(VersionedTable):
    """An item table, the later pull_date wins, whose versions state their schema.

    A load may bring columns and wider types.  The entry that makes a version current also states its schema, so
    readers see both or neither.  Groups that the load does not change stay as they are where their files read
    under the new schema; else the table is written once.  A column that a load lacks is NULL in
    the rows that it writes.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, rows_per_group: int = ROWS_PER_GROUP):
        super().__init__(spark, base, schema, rows_per_group)
        self.first_schema = schema

    def stated_schema(self) -> str:
        return self.schema.json()

    def newest(self) -> Version:
        version = super().newest()
        self.schema = T.StructType.fromJson(json.loads(version.schema)) if version.schema else self.first_schema
        return version

    def upsert(self, rows: DataFrame) -> dict:
        old = self.newest()
        before, after = self.schema, evolved(self.schema, rows.schema)
        given = conform(rows, after)
        if reads_in_place(before, after):
            self.schema = after
            return self.merge_into(old, given)
        kept = conform(self._read(old.parts.values()), after)
        self.schema = after
        return self.rewrite(classified_upsert(kept, given), old, None, None, **outcome_counts())
