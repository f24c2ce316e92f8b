"""CSV in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CLEAN_SCHEMA, EXPORT_TIMESTAMP_FORMAT, STAGE_COLUMNS, STAGE_SCHEMA
from .quoted import files_with_breaks, lines_of, records_of

# An unquoted empty field is NULL and a quoted one is an empty string. Spark reads both as NULL
# unless the NULL marker is a text that cannot occur.
_NEVER = "\u0000"
# Rows of a CSV file at most.
FILE_ROWS = 500_000


def _reader(spark: SparkSession, schema: T.StructType):
    return (
        spark.read.schema(schema)
        .option("header", True)
        # the header must name the fields in their order, or every value would land in a wrong one
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
    )


def load_stage(spark: SparkSession, path: str, breaks: bool = True) -> DataFrame:
    """Stage a ticket export: header checked, every column text, so no value can fail the load.

    Quoted fields may hold line breaks; a file that has some is still read in splits (see :mod:`quoted`),
    the others by Spark's own reader. One pass over the files, made at once, tells them apart; with ``breaks``
    off it is left out, for exports known to have none. Quotes must stand around whole fields, and inside
    them be doubled; a quoted field that is never closed stops the load.
    """
    if not breaks:
        return _staged(spark, path)
    found = files_with_breaks(lines_of(spark, path))
    broken = sorted(file for file, has in found.items() if has)
    plain = sorted(file for file, has in found.items() if not has)
    if not broken:
        return _staged(spark, path)
    schema = ", ".join(f"{name} string" for name in STAGE_COLUMNS)
    options = {"mode": "FAILFAST", "escape": '"', "nullValue": _NEVER, "multiLine": "true"}
    cells = records_of(spark, broken, STAGE_COLUMNS).select(F.from_csv("record", schema, options).alias("r"))
    staged = cells.select("r.*")
    return _staged(spark, plain).unionByName(staged) if plain else staged


def _staged(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _reader(spark, STAGE_SCHEMA).option("nullValue", _NEVER).csv(path)


def load_clean(spark: SparkSession, path: str) -> DataFrame:
    """Read a cleaned CSV export with its types."""
    reader = _reader(spark, CLEAN_SCHEMA)
    return reader.option("timestampNTZFormat", EXPORT_TIMESTAMP_FORMAT).csv(path)


def write_csv(
    df: DataFrame, path: str, sort: Sequence[str] = (), file_rows: int = FILE_ROWS
) -> None:
    """Write CSV with a header; NULL becomes an empty field, times have a fixed format.

    No file has more than ``file_rows``. With ``sort`` the export is sorted as a whole: files hold ranges of rows, and
    read one after the other by name they give all rows in order. Many equal values are spread over files too.
    """
    rows = df
    if sort:
        held = df.withColumns({"_hash": F.xxhash64(*df.columns), "_row": F.monotonically_increasing_id()})
        order = [*sort, "_hash", "_row"]
        rows = held.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash", "_row")
    (
        rows.write.mode("overwrite")
        .option("header", True)
        .option("maxRecordsPerFile", file_rows)
        .option("nullValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", EXPORT_TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", EXPORT_TIMESTAMP_FORMAT)
        .csv(path)
    )
