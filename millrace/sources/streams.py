"""Streaming readers over folders.

Swap in any other streaming source with the same columns; the operators take
frames, not paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def _reader(spark: SparkSession, files_per_batch: int | None):
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def line_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Text lines (column ``value``) as files arrive in a folder."""
    return _reader(spark, files_per_batch).text(folder)


def csv_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    header: bool = False,
) -> DataFrame:
    return _reader(spark, files_per_batch).schema(schema).csv(folder, header=header)


def parquet_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    return _reader(spark, files_per_batch).schema(schema).parquet(folder)
