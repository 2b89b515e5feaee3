"""Running values over any key and order, with no bucket to choose: a distributed prefix scan.

Rows are dealt by range over (keys, order, tiebreak), for which Spark samples
the split points, so a key that owns most of the rows is spread over as many
tasks as its share demands. One summary row a key and partition tells what the
partition holds of that key; these rows, a few for each partition, are summed up
across partitions, and every row adds what the earlier partitions carry to what
its own partition has so far.

The ranged rows are written once: the split points are drawn from the data, so
both readers must see the same partitions, also after the loss of an executor.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from millrace.operators.layout import written

_PART = "__part"


@dataclass(frozen=True)
class Line:
    """Rows of each key in a total order; NULLs come first ascending, last descending."""

    keys: Sequence[str]
    order: Sequence[str]
    descending: bool = False
    partitions: int | None = None

    def directed(self) -> list[Column]:
        return [F.col(name).desc() if self.descending else F.col(name).asc() for name in self.order]


class _Ranged:
    """Rows in range partitions, each with its number, written so that the numbers stay."""

    def __init__(self, df: DataFrame, line: Line):
        self.line = line
        sort = [*(F.col(k).asc() for k in line.keys), *line.directed()]
        dealt = df.repartitionByRange(line.partitions, *sort) if line.partitions else df.repartitionByRange(*sort)
        self.rows = written(dealt.withColumn(_PART, F.spark_partition_id()), "ranged")

    def within(self) -> WindowSpec:
        return Window.partitionBy(_PART, *self.line.keys).orderBy(*self.line.directed())

    def across(self) -> WindowSpec:
        return Window.partitionBy(*self.line.keys).orderBy(_PART)

    def joined(self, summary: DataFrame, *carries: str) -> DataFrame:
        """Rows with the carries of their key and partition."""
        names = [_PART, *self.line.keys]
        other = summary.select(*(F.col(n).alias(f"__s{i}") for i, n in enumerate(names)), *carries)
        condition = None
        for i, name in enumerate(names):
            step = self.rows[name].eqNullSafe(other[f"__s{i}"]) if name != _PART else self.rows[name] == other[f"__s{i}"]
            condition = step if condition is None else condition & step
        return self.rows.join(other, condition).drop(*(f"__s{i}" for i in range(len(names))))


def _scan(df: DataFrame, line: Line, name: str, amount: Column, local: Callable[[WindowSpec], Column], combine=F.sum, add=None) -> DataFrame:
    ranged = _Ranged(df, line)
    summary = ranged.rows.groupBy(_PART, *line.keys).agg(amount.alias("__amount"))
    before = combine("__amount").over(ranged.across().rowsBetween(Window.unboundedPreceding, -1))
    joined = ranged.joined(summary.withColumn("__before", before), "__before")
    own = local(ranged.within())
    value = add(own, F.col("__before")) if add else own + F.coalesce(F.col("__before"), F.lit(0))
    return joined.withColumn(name, value).select(*df.columns, name)


def _upto(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_sum(df: DataFrame, line: Line, value: Column, name: str = "running_sum") -> DataFrame:
    """Sum from the key's first row up to and including this one; NULL adds nothing."""
    solid = F.coalesce(value, F.lit(0))
    return _scan(df, line, name, F.sum(solid), lambda w: F.sum(solid).over(_upto(w)))


def running_count(df: DataFrame, line: Line, name: str = "running_count") -> DataFrame:
    """Number of each row within its key, from 1."""
    return _scan(df, line, name, F.count("*"), lambda w: F.row_number().over(w))


def running_max(df: DataFrame, line: Line, value: Column, name: str = "running_max") -> DataFrame:
    """Largest value so far; NULL before the first."""
    return _scan(df, line, name, F.max(value), lambda w: F.max(value).over(_upto(w)), F.max, F.greatest)


def running_min(df: DataFrame, line: Line, value: Column, name: str = "running_min") -> DataFrame:
    """Smallest value so far; NULL before the first."""
    return _scan(df, line, name, F.min(value), lambda w: F.min(value).over(_upto(w)), F.min, F.least)


def rank(df: DataFrame, line: Line, by: Sequence[str], name: str = "rank") -> DataFrame:
    """Rank with gaps of the leading order columns ``by``; rows that tie may lie in several partitions.

    A row's rank is the number of the first row of its value: the running
    maximum of the numbers at which a new value begins.
    """
    numbered = running_count(df, line, "__n")
    before = previous(numbered, line, F.struct(*by), "__last")
    begins = F.when(F.col("__last").isNull() | ~F.col("__last").eqNullSafe(F.struct(*by)), F.col("__n"))
    return running_max(before, line, begins, name).select(*df.columns, F.col(name).cast("long").alias(name))


def dense_rank(df: DataFrame, line: Line, by: Sequence[str], name: str = "dense_rank") -> DataFrame:
    """Rank without gaps of the leading order columns ``by``: the number of values that began so far."""
    before = previous(df, line, F.struct(*by), "__last")
    begins = F.when(F.col("__last").isNull() | ~F.col("__last").eqNullSafe(F.struct(*by)), 1).otherwise(0).cast("long")
    return running_sum(before, line, begins, name).select(*df.columns, name)


def previous(df: DataFrame, line: Line, value: Column, name: str = "previous") -> DataFrame:
    """Value of the row before within the key; NULL for the first."""
    return _neighbour(df, line, value, name, F.lag, F.max_by)


def following(df: DataFrame, line: Line, value: Column, name: str = "following") -> DataFrame:
    """Value of the row after within the key; NULL for the last."""
    return _neighbour(df, line, value, name, F.lead, F.min_by)


def _neighbour(df: DataFrame, line: Line, value: Column, name: str, step, edge) -> DataFrame:
    ranged = _Ranged(df, line)
    # A struct around the value keeps a NULL value apart from "no row". The order may hold NULLs, which
    # no maximum sees, so the edge row is the one with the first or last number in its partition.
    held = F.struct(value.alias("v"))
    placed = ranged.rows.withColumn("__at", F.row_number().over(ranged.within())).withColumn("__held", held)
    summary = placed.groupBy(_PART, *line.keys).agg(edge("__held", "__at").alias("__edge"))
    outside = step("__edge").over(ranged.across())
    joined = ranged.joined(summary.withColumn("__outside", outside), "__outside")
    inside = step(held).over(ranged.within())
    return joined.withColumn(name, F.coalesce(inside, F.col("__outside"))["v"]).select(*df.columns, name)
