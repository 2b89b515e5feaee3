"""Batch writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder with header, written in parallel."""
    df.write.mode("overwrite").csv(path, header=True)


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV report, in parallel or, if the caller knows that it is small, as one file."""
    write_csv(df.coalesce(1) if single_file else df, path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Parquet folders per value of the partition columns.

    Rows are first brought together by those columns so that a folder holds
    few files; the rebalance hint lets Spark split a folder that owns far
    more rows than the others over several tasks.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)
