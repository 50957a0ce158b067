"""Rejected price rows tried again under corrected rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetrail.operators.conform import BAD_COLUMNS, ORIGIN_FILE, ORIGIN_ROW, RECORD, REJECT_TRACE, conform_checked
from pricetrail.operators.merge import PRICE_KEY, new_price_rows, one_per_key
from pricetrail.plans.loads import one_row
from pricetrail.plans.maintained import Maintained
from pricetrail.schemas import PRICES
from pricetrail.session import scratch_dir
from pricetrail.sources.landing import append_prices, open_prices, open_table, write_observed

REJECT_KEY = (ORIGIN_FILE, ORIGIN_ROW)
REJECTS = T.StructType([*PRICES.fields, T.StructField(BAD_COLUMNS, T.ArrayType(T.StringType())), *REJECT_TRACE])
SETTLED = T.StructType([field for field in REJECT_TRACE if field.name in REJECT_KEY])


def outstanding_rejects(spark: SparkSession, rejects_path: str) -> DataFrame:
    """Rejected rows of all loads below a folder that no replay has let through, one per file and row.

    A load that was interrupted and repeated rejects the same rows twice; they count once.
    """
    try:
        kept = spark.read.schema(REJECTS).option("recursiveFileLookup", True).parquet(rejects_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REJECTS)
    settled = open_table(spark, f"{rejects_path}/_settled", SETTLED)
    values = [F.asc_nulls_last(name) for name in PRICES.fieldNames()]
    single = one_per_key(kept.filter(F.col(RECORD).isNotNull()), REJECT_KEY, *values)
    return single.join(settled, list(REJECT_KEY), "left_anti").select(REJECTS.fieldNames())


def replay_rejects(
    spark: SparkSession,
    target_path: str,
    rules: Mapping[str, Column],
    rejects_path: str | None = None,
    maintained: Maintained | None = None,
) -> DataFrame:
    """Try the rejected rows of a price table again; returns one row of counts and a message.

    ``rules`` give target columns anew.  They see the values of a row as they came, as text: the
    table's columns by name, all others in the map ``reject_record``.  A row that converts and has its key is merged as
    any load merges, and settled; the rest stays outstanding.  Rows are settled after the data, by file and row, so
    an interrupted replay is repeated, and the merge absorbs the repetition.  No source file is read again.
    """
    rejects = (rejects_path or f"{target_path}/_rejects").rstrip("/")
    unknown = sorted(set(rules) - set(PRICES.fieldNames()))
    if unknown:
        raise ValueError(f"rules for columns that the table does not have: {', '.join(unknown)}")
    if maintained:
        maintained.recover()
    given = outstanding_rejects(spark, rejects).select(
        *REJECT_KEY, RECORD, *[F.col(RECORD)[name.lower()].alias(name) for name in PRICES.fieldNames()]
    )
    corrected = given.withColumns(dict(rules)) if rules else given
    checked = conform_checked(corrected, T.StructType([*PRICES.fields, *SETTLED.fields]), required=PRICE_KEY)
    path = scratch_dir(spark, "replayed")
    fit = F.size(BAD_COLUMNS) == 0
    seen = write_observed(
        checked, lambda writer: writer.parquet(path), let_through=F.count_if(fit), left=F.count_if(~fit)
    )
    inserted = 0
    if seen["let_through"]:
        staged = spark.read.schema(checked.schema).parquet(path).filter(fit)
        fresh = new_price_rows(open_prices(spark, target_path), staged.select(PRICES.fieldNames()), keyless=False)
        inserted = maintained.append(fresh) if maintained else append_prices(fresh, target_path)
        staged.select(SETTLED.fieldNames()).hint("rebalance").write.mode("append").parquet(f"{rejects}/_settled")
    message = f"{seen['let_through']} rejected rows let through, {inserted} inserted, {seen['left']} left"
    return one_row(
        spark, rows_let_through=seen["let_through"], rows_inserted=inserted, rows_left=seen["left"], message=message
    )
