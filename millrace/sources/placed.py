"""Lines that do not fit their schema, with the file and block they stand in and their bytes as they were.

The CSV and JSON readers turn what they cannot read into nulls. Here a file is
read as lines and parsed by ``from_csv`` or ``from_json`` in the same pass, so
every line is either a record or a reject that tells why, from where, and all
its bytes, also those that are no UTF-8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

NOT_UTF8, EMPTY, UNFIT = "not UTF-8", "empty line", "does not fit the schema"
_CORRUPT = "__corrupt"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    # Only the line feed ends a line, so that no other byte gets lost.
    lines = spark.read.option("lineSep", "\n").text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start")]
    return lines.select(*place, "value")


def _marked(lines: DataFrame, record: Column) -> DataFrame:
    marked = lines.withColumn("record", record)
    reason = (
        F.when(~F.is_valid_utf8("value"), NOT_UTF8)
        .when(F.trim(F.regexp_replace("value", r"\s+", " ")) == "", EMPTY)
        .when(F.col("record").isNull() | F.col(f"record.{_CORRUPT}").isNotNull(), UNFIT)
    )
    return marked.withColumn("reason", reason)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])


def _text() -> Column:
    return F.regexp_replace("value", r"\r\z", "")


_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}


def placed_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = False, sep: str = ",") -> DataFrame:
    """Lines (file, block_start, value, record, reason) of CSV files whose records take one line each.

    A line with another number of fields, or with a field that is not of its
    type, is a reject. With ``header`` lines that name the columns are neither.
    """
    lines = _lines(spark, path)
    if header:
        lines = lines.filter(_text() != sep.join(schema.names))
    # Schemas of from_csv are given as text.
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _with_corrupt(schema).fields)
    return _marked(lines, F.from_csv(_text(), kinds, {**_OPTIONS, "sep": sep}))


def placed_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``placed_csv`` for JSON, one object a line; fields that an object lacks are null."""
    return _marked(_lines(spark, path), F.from_json(_text(), _with_corrupt(schema), _OPTIONS))


def records(marked: DataFrame) -> DataFrame:
    """The lines that fit, as columns of the schema."""
    return marked.filter("reason IS NULL").select("record.*").drop(_CORRUPT)


def rejects(marked: DataFrame) -> DataFrame:
    """(file, block_start, reason, raw): the other lines, with their bytes."""
    return marked.filter("reason IS NOT NULL").select("file", "block_start", "reason", F.col("value").cast("binary").alias("raw"))
