"""Play-by-play CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swishline.schemas import PLAYS

# Spark reads a quoted empty field as null unless it has a text of its own
QUOTED_EMPTY = "\u0001"
# the usual rules of CSV: a quote inside a quoted field is doubled, a backslash is a backslash
QUOTING = {"quote": '"', "escape": '"'}


def scan_plays(
    spark: SparkSession, path: str, extra: tuple[str, ...] = (), multi_line: bool = False
) -> DataFrame:
    """Plays from CSV files with a header, columns matched by name in any case.

    The files may hold more columns, in any order. Spark would match a given
    schema by position, so the header is read first; the scan then checks that
    every file has that header, and prunes the columns nobody asked for.
    ``extra`` names further columns to keep, as text. ``multi_line`` allows line breaks
    inside quoted fields; a file is then read by one task, as it cannot be cut at
    line breaks any more.
    """
    options = {**QUOTING, "header": "true", "multiLine": str(multi_line).lower()}
    header = spark.read.options(**options).csv(path).columns
    by_name = {name.lower(): name for name in header}
    wanted = [field.name for field in PLAYS] + list(extra)
    missing = [name for name in wanted if name not in by_name]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; it has {header}")

    layout = T.StructType([T.StructField(name, T.StringType()) for name in header])
    reader = spark.read.schema(layout).options(**options).option("enforceSchema", False)
    raw = reader.option("emptyValue", QUOTED_EMPTY).csv(path)
    fields = [T.StructField(name, T.StringType()) for name in extra] + PLAYS.fields
    return raw.select(*[_typed(by_name[field.name], field) for field in fields])


def _typed(source: str, field: T.StructField) -> Column:
    column = F.col(f"`{source}`")
    if isinstance(field.dataType, T.IntegerType):
        # by way of double: some exports write whole numbers as "1.0"
        return column.try_cast("double").try_cast("int").alias(field.name)
    return F.when(column == QUOTED_EMPTY, "").otherwise(column).alias(field.name)


def write_plays(plays: DataFrame, path: str) -> None:
    """Plays as CSV with a header. Empty and missing text stay distinct."""
    # blanks at the ends of a field belong to it, as they do when it is read
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    writer = plays.write.options(**QUOTING, **kept).option("header", True)
    writer.mode("errorifexists").csv(path)
