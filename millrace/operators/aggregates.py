"""Grouped measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions import exact
from millrace.functions.money import total


def share_of_total(df: DataFrame, keys: Sequence[str], value: Column, name: str = "share_pct") -> DataFrame:
    """Each group's part of the grand total in percent.

    A grand total of zero has no shares: they are NULL. The total is a scalar subquery over the grouped sums: one row, no window
    over all groups and no trip through the driver program. It is exact, as the groups pass on unrounded parts.
    """
    grouped = df.groupBy(*keys).agg(*exact.parts(value).named("__sum"))
    grand = grouped.select(exact.merged("__sum").rounded()).scalar()
    summed = grouped.select(*keys, exact.held("__sum").rounded().alias("total"))
    return summed.withColumn(name, F.try_divide(F.col("total") * 100, grand))


def pivot_sum(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence[object], value: Column
) -> DataFrame:
    """One column per listed value; combinations without rows become 0.

    The values are part of the call, so Spark needs no extra pass to find
    them and the result has a fixed schema.
    """
    pivoted = df.groupBy(*keys).pivot(column, list(values)).agg(total(value))
    return pivoted.na.fill(0.0, subset=[str(v) for v in values])


def spread(value: Column) -> list[Column]:
    """Lowest, highest, gap and sample standard deviation."""
    return [
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        (F.max(value) - F.min(value)).alias("gap"),
        F.stddev_samp(value).alias("std_dev"),
    ]


def collect_in_chunks(
    df: DataFrame, keys: Sequence[str], value: str, position: str, chunk_size: int = 1000
) -> DataFrame:
    """All values of each key as sorted lists of bounded length.

    ``position`` is a unique integer; a chunk covers ``chunk_size`` of its
    values, so no list outgrows the limit however many rows a key has.
    """
    chunk = F.expr(f"`{position}` div {chunk_size}").alias("chunk")
    return df.groupBy(*keys, chunk).agg(F.sort_array(F.collect_list(value)).alias("collected"))


def array_mean(values: Column) -> Column:
    """Mean of a numeric list within its row; NULL for an empty list."""
    summed = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.try_divide(summed, F.size(values).cast("double"))


def best_row(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The single first row in the given order (top-k, no full sort)."""
    return df.orderBy(*order).limit(1)


def numbered_top(df: DataFrame, order: Sequence[Column], n: int, name: str = "position") -> DataFrame:
    """First ``n`` rows with their position; the window sees ``n`` rows only."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def rows_per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))
