"""Reading the nested JSON snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetrail.schemas import RAW_SNAPSHOT

CORRUPT = "_corrupt_record"


def read_snapshot(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_SNAPSHOT,
    layout: str = "lines",
) -> DataFrame:
    """Records of a snapshot, under an explicit schema whose first field identifies them.

    A value of the wrong type becomes NULL in its record; text that yields no record at all
    is left to ``snapshot_rejects``.

    ``lines``        one object per line; splits across tasks
    ``array_lines``  one JSON array with each element on its own line; splits too
    ``array``        any other JSON array; Spark parses each file in one task, so convert
                     large files to lines at the source
    """
    return readable(parse_snapshot(spark, path, schema, layout), schema)


def snapshot_rejects(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_SNAPSHOT,
    layout: str = "lines",
) -> DataFrame:
    """The text that ``read_snapshot`` could not parse."""
    return unreadable(parse_snapshot(spark, path, schema, layout), schema)


def readable(parsed: DataFrame, schema: T.StructType = RAW_SNAPSHOT) -> DataFrame:
    return parsed.filter(~is_unreadable(schema)).drop(CORRUPT)


def unreadable(parsed: DataFrame, schema: T.StructType = RAW_SNAPSHOT) -> DataFrame:
    return parsed.filter(is_unreadable(schema)).select(F.col(CORRUPT).alias("record"))


def is_unreadable(schema: T.StructType = RAW_SNAPSHOT) -> Column:
    # A plain test for a NULL id would reach the JSON parser, which then stops at an id and
    # never sees that the rest of the record is broken.
    with_id = F.concat(F.col(CORRUPT), F.col(schema.fieldNames()[0]).cast("string"))
    return F.col(CORRUPT).isNotNull() & with_id.isNull()


def _elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text of each element of an array with one element per line."""
    # An element is an object, so brackets and commas outside its braces belong to the array.
    body = F.regexp_replace("value", r"^[\s\[,]+|[\s\],]+$", "")
    return spark.read.text(path).select(body.alias("record")).filter(F.col("record") != "")


def snapshot_fields(spark: SparkSession, path: str | list[str], layout: str = "lines", most: int = 1000) -> list[str]:
    """The names of all top-level fields that some record has, in order; more than ``most`` are an error.

    Names are grouped in the tasks that read, over all records.
    """
    if layout == "array":
        names = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path).columns
    else:
        records = _elements(spark, path) if layout == "array_lines" else spark.read.text(path).toDF("record")
        # Only an object that parses whole has fields.
        names = records.select(F.explode(F.json_object_keys("record")).alias("name")).distinct().limit(most + 1)
        names = [row["name"] for row in names.collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} fields")
    return sorted(name for name in names if name != CORRUPT)


def parse_snapshot(
    spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_SNAPSHOT, layout: str = "lines"
) -> DataFrame:
    """All records with the text of the unreadable ones, for one pass over both."""
    wanted = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    if layout == "array_lines":
        lines = _elements(spark, path)
        options = {"columnNameOfCorruptRecord": CORRUPT}
        return lines.select(F.from_json("record", wanted, options).alias("r")).select("r.*")
    if layout not in ("lines", "array"):
        raise ValueError(f"unknown snapshot layout: {layout}")
    reader = spark.read.schema(wanted).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("multiLine", layout == "array").json(path)
