"""Batch readers. Every reader takes a declared schema where the format allows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file, one row per line (column ``value``)."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header and declared types; unreadable fields become NULL."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, types guessed in an extra pass. For exploring only."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, every column as text, to be cast by the quality step."""
    return spark.read.csv(path, header=True)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str, *conditions) -> DataFrame:
    """Parquet; conditions on partition columns prune folders."""
    df = spark.read.parquet(path)
    for condition in conditions:
        df = df.filter(condition)
    return df


def rows(spark: SparkSession, data: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table from memory: reference rows and test fixtures."""
    return spark.createDataFrame(list(data), schema)


def generated_facts(
    spark: SparkSession, n: int, keys: int, seed: int = 42, top: int = 10000
) -> DataFrame:
    """Numbered rows spread over ``keys`` keys with a seeded random amount."""
    return spark.range(n).select(
        F.col("id").alias("txn_id"),
        (F.col("id") % keys).cast("int").alias("branch_id"),
        (F.rand(seed) * top).cast("int").alias("amount"),
    )


def as_views(**frames: DataFrame) -> Sequence[str]:
    """Register frames under their argument names for SQL text."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)
