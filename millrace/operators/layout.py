"""Partition layout, reuse and plan inspection."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from millrace.session import fresh_folder


def spread_evenly(df: DataFrame, partitions: int) -> DataFrame:
    """Round-robin into a number of partitions, up or down."""
    return df.repartition(partitions)


def spread_by(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Hash partitioning for several steps on the same key."""
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def shrink(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer partitions without a shuffle; never more than before."""
    return df.coalesce(partitions)


@contextlib.contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame for several outputs and release it afterwards."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def written(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame to the shared work folder and read it back.

    Cuts the lineage in a way that survives the loss of executors.
    """
    path = fresh_folder(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
