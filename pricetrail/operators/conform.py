"""Loading by column name, with bad values set aside."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_COLUMNS = "bad_columns"
RECORD, ORIGIN_FILE, ORIGIN_ROW = "reject_record", "reject_file", "reject_row"

REJECT_TRACE = (
    T.StructField(RECORD, T.MapType(T.StringType(), T.StringType())),
    T.StructField(ORIGIN_FILE, T.StringType()),
    T.StructField(ORIGIN_ROW, T.LongType()),
)


def _source_names(df: DataFrame, renames: dict[str, str] | None) -> dict[str, str]:
    """Lower-cased target name -> source column."""
    renames = {old.lower(): new.lower() for old, new in (renames or {}).items()}
    pairs = [(renames.get(name.lower(), name.lower()), name) for name in df.columns]
    doubled = sorted(name for name, n in Counter(name for name, _ in pairs).items() if n > 1)
    if doubled:
        raise ValueError(f"columns match more than once: {', '.join(doubled)}")
    return dict(pairs)


def _typed(df: DataFrame, schema: T.StructType, renames) -> list[tuple[T.StructField, Column | None, Column]]:
    """Each target field with its source column, if there is one, and its typed value."""
    names = _source_names(df, renames)
    typed = []
    for field in schema:
        source = names.get(field.name.lower())
        raw = None if source is None else F.col(f"`{source}`")
        value = F.lit(None).cast(field.dataType) if raw is None else raw.try_cast(field.dataType)
        typed.append((field, raw, value.alias(field.name)))
    return typed


def conform(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Columns of ``schema``, matched by name in any case.

    A missing column becomes NULL, an extra one is left out, and a value that does not
    convert becomes NULL.
    """
    return df.select([value for _, _, value in _typed(df, schema, renames)])


def conform_checked(
    df: DataFrame,
    schema: T.StructType,
    renames: dict[str, str] | None = None,
    required: Collection[str] = (),
) -> DataFrame:
    """``conform`` plus an array naming the columns that make a row unfit to load.

    Those are columns whose value did not convert, and ``required`` columns without a value.
    """
    failed = []
    typed = _typed(df, schema, renames)
    for field, raw, _ in typed:
        bad = F.lit(False)
        if field.name in required:
            bad = F.lit(True) if raw is None else raw.try_cast(field.dataType).isNull()
        elif raw is not None:
            bad = raw.isNotNull() & raw.try_cast(field.dataType).isNull()
        failed.append(F.when(bad, F.lit(field.name)))
    return df.select(*[value for _, _, value in typed], F.array_compact(F.array(*failed)).alias(BAD_COLUMNS))


def conform_traced(
    df: DataFrame,
    schema: T.StructType,
    renames: dict[str, str] | None = None,
    required: Collection[str] = (),
) -> DataFrame:
    """``conform_checked``, where an unfit row also keeps its values as they came, and where it came from.

    The values are a map from lower-cased column name to text.  File and row number are those
    of ``Stage.read_files``; a row without them is told by a hash of its values, so that equal rows count once.
    """
    origin = {ORIGIN_FILE: F.lit(None).cast("string"), ORIGIN_ROW: F.lit(None).cast("bigint")}
    given = df.withColumns({name: value for name, value in origin.items() if name not in df.columns})
    own = [name for name in given.columns if name not in origin]
    pairs = [part for name in own for part in (F.lit(name.lower()), F.col(f"`{name}`").cast("string"))]
    record = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    held = given.withColumn(RECORD, record)
    checked = conform_checked(held, T.StructType([*schema.fields, *REJECT_TRACE]), renames, required)
    unfit = F.size(BAD_COLUMNS) > 0
    by_value = F.xxhash64(F.map_entries(RECORD))
    return checked.withColumns({
        ORIGIN_ROW: F.when(unfit, F.coalesce(ORIGIN_ROW, by_value)),
        ORIGIN_FILE: F.when(unfit, F.coalesce(ORIGIN_FILE, F.lit(""))),
        RECORD: F.when(unfit, F.col(RECORD)),
    })


def split_rejects(
    df: DataFrame,
    schema: T.StructType,
    renames: dict[str, str] | None = None,
    required: Collection[str] = (),
    nulls: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Rows that load, and rows that do not together with the offending column names.

    With ``nulls``, only a missing ``required`` value rejects; other bad values load as NULL.
    """
    checked = conform_checked(df, schema, renames, required)
    unfit = F.array_intersect(BAD_COLUMNS, F.array(*[F.lit(c) for c in required])) if nulls else F.col(BAD_COLUMNS)
    clean = F.size(unfit) == 0
    return checked.filter(clean).drop(BAD_COLUMNS), checked.filter(~clean)
