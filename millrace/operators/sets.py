"""Union, distinct and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from millrace.operators.windows import latest_per_key


def append(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both, matched by column name, duplicates kept."""
    return left.unionByName(right)


def append_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def one_per_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column]) -> DataFrame:
    """Drop duplicates by key; the survivor is the first in ``prefer`` order.

    With an order that covers every column the survivor never depends on the
    arrival of rows, unlike ``dropDuplicates``.
    """
    return latest_per_key(df, keys, prefer)
