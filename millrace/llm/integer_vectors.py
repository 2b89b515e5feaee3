"""Vectors as exact integers: the input of the integer operators, and sums of them over groups.

Components become whole numbers in Spark expressions. Inside a task, small ones
are handled as doubles, which hold every product and sum exactly below 2^53,
and larger ones as Python's integers: results are exact either way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# Scaled components beyond this count as this.
LARGEST = 2**62
LONGEST = 2**63 - 1
LOW_BITS = 31


def integers(vectors: DataFrame, factor: int, vec_id: str = "vec_id", embedding: str = "embedding", **others: str) -> DataFrame:
    """(vec_id, vec array<long>, others): floor(factor * x) of every component x, taken as a double.

    Vectors that are null or hold null or non-finite components are left out.
    ``others`` names columns to keep as new_name=column.
    """
    column = F.col(f"`{embedding}`").cast("array<double>")
    kept = [F.col(f"`{source}`").alias(name) for name, source in others.items()]
    chosen = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), column.alias("vec"), *kept)
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform("vec", lambda x: F.floor(F.greatest(F.least(x * F.lit(float(factor)), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))))
    return chosen.filter(F.col("vec").isNotNull() & finite).withColumn("vec", scaled)


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, int64 matrix) for each length of vector in a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        yield rows, values[starts[rows][:, None] + np.arange(size)]


def largest(*arrays: np.ndarray) -> int:
    return max((int(np.abs(a).max()) for a in arrays if a.size), default=0)


def exact(rows: np.ndarray, bound: int) -> np.ndarray:
    """Integers as doubles where ``bound`` shows that all arithmetic stays exact, else as Python's integers."""
    return rows.astype(np.float64) if bound < 2**53 else rows.astype(object)


def longs(values: np.ndarray) -> np.ndarray:
    """Exact results as longs; what lies beyond counts as the largest or smallest."""
    if values.dtype == object:
        values = np.array([max(-LONGEST, min(LONGEST, int(v))) for v in values], np.int64)
    return values.astype(np.int64)


class Sums:
    """Exact sums of rows by group, gathered within a task."""

    def __init__(self, groups: int, size: int):
        self.small = np.zeros((groups, size), np.int64)
        self.big = None
        self.counts = np.zeros(groups, np.int64)

    def add(self, group: np.ndarray, rows: np.ndarray) -> None:
        self.counts += np.bincount(group, minlength=len(self.counts))
        if rows.dtype == object:
            self.big = np.zeros(self.small.shape, object) if self.big is None else self.big
            np.add.at(self.big, group, rows)
        else:
            np.add.at(self.small, group, rows.astype(np.int64))

    def table(self, first_group: int = 0) -> pa.RecordBatch:
        """(group, place, high, low): the parts of each sum; place -1 holds the number of rows."""
        used = np.flatnonzero(self.counts)
        sums = self.small[used].astype(object) + (self.big[used] if self.big is not None else 0)
        sums = np.concatenate([self.counts[used, None].astype(object), sums], axis=1)
        group = np.repeat(used + first_group, sums.shape[1])
        place = np.tile(np.arange(-1, sums.shape[1] - 1), len(used))
        flat = sums.ravel()
        high, low = [int(s) >> LOW_BITS for s in flat], [int(s) & (2**LOW_BITS - 1) for s in flat]
        columns = [pa.array(group, pa.int32()), pa.array(place, pa.int32()), pa.array(high, pa.int64()), pa.array(low, pa.int64())]
        return pa.record_batch(columns, ["group", "place", "high", "low"])


def group_sums(rows: DataFrame, gather: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> dict[int, tuple[int, list[int]]]:
    """group -> (rows, sums): what the tables of all tasks add up to; the driver sees one row per group and place."""
    parts = rows.mapInArrow(gather, "`group` int, place int, high long, low long")
    total = parts.groupBy("group", "place").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    out: dict[int, tuple[int, list[int]]] = {}
    for row in sorted(total.collect(), key=lambda r: (r["group"], r["place"])):
        value = (row["high"] << LOW_BITS) + row["low"]
        if row["place"] < 0:
            out[row["group"]] = (value, [])
        else:
            out[row["group"]][1].append(value)
    return out


def moved(entries: list[list[int]], sums: dict[int, tuple[int, list[int]]], first_group: int = 0) -> list[list[int]]:
    """Every entry replaced by the floor of its rows' mean; entries without rows stay."""
    out = []
    for number, entry in enumerate(entries):
        count, total = sums.get(first_group + number, (0, []))
        out.append([s // count for s in total] if count else list(entry))
    return out
