"""Tables that are laid out once for many joins on one key.

Both sides are bucketed and sorted by the key, so a later join reads bucket by
bucket and shuffles nothing. Such a join cannot be split where one key is hot,
since adaptive handling works on shuffles. Hot keys are therefore named when the
tables are written, and their rows go to plain files beside the buckets: they
are joined with a shuffle, which adaptive execution may split. A key is hot in
all tables or in none, so any kind of equi-join is the union of both parts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.layout import written
from millrace.session import fresh_folder

BUCKETS = 200
HOT_ROWS = 5_000_000


@dataclass(frozen=True)
class Bucketed:
    """A laid-out table: the name of its bucketed part and the folder of the rows of hot keys."""

    spark: SparkSession
    table: str
    hot_folder: str
    key: str

    def even(self) -> DataFrame:
        return self.spark.table(self.table)

    def hot(self) -> DataFrame:
        return self.spark.read.schema(self.even().schema).parquet(self.hot_folder)

    def rows(self) -> DataFrame:
        return self.even().union(self.hot())

    def join(self, other: Bucketed, how: str = "inner") -> DataFrame:
        """Join with a table of the same layout; the larger part of either side is not shuffled."""
        return self.even().join(other.even(), self.key, how).unionByName(self.hot().join(other.hot(), self.key, how))


def hot_keys(frames: Sequence[DataFrame], key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows in one of the frames: at most rows / hot_rows of each. Null is none of them."""
    found = []
    for frame in frames:
        counted = frame.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
        found.append(counted.filter(F.col("__n") > hot_rows).select(key))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every.distinct()


def lay_out(
    frames: dict[str, DataFrame], key: str, buckets: int = BUCKETS, hot_rows: int = HOT_ROWS
) -> dict[str, Bucketed]:
    """Write frames bucketed by a key that all of them have, under the shared work folder.

    ``hot_rows`` is what one task of a join may hold of one key. Rows whose key
    is null stay in the buckets: no join on the key reads them twice.
    """
    spark = next(iter(frames.values())).sparkSession
    hot = written(hot_keys(list(frames.values()), key, hot_rows), "hot-keys")
    out = {}
    for name, frame in frames.items():
        folder, table = fresh_folder(spark, name), f"{name}_{uuid.uuid4().hex[:8]}"
        even = frame.join(hot, key, "left_anti").select(frame.columns).repartition(buckets, key)
        even.write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/even").saveAsTable(table)
        frame.join(hot, key, "left_semi").select(frame.columns).write.parquet(f"{folder}/hot")
        out[name] = Bucketed(spark, table, f"{folder}/hot", key)
    return out
