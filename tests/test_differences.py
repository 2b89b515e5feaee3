"""Differences of whole tables."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import differences as d


def test_finds_the_changed_rows_of_many(spark):
    left = spark.range(1_000_000).select("id", (F.xxhash64("id") % 1000).alias("v"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("t"))
    changed = F.col("id").isin(5, 77_777, 999_999)
    right = left.withColumn("v", F.when(changed, F.col("v") + 1).otherwise(F.col("v"))).select("t", "v", "id").repartition(3)
    assert d.differing_parts(left, right, ["id"]).count() == 3
    found = d.differences(left, right, ["id"]).collect()
    assert sorted((r.id, r.side, r.surplus) for r in found) == sorted((i, s, 1) for i in (5, 77_777, 999_999) for s in ("left", "right"))
    assert d.differences(left, left.repartition(7), ["id"]).isEmpty()


@pytest.mark.parametrize("parts", [1, 5, 1000])
def test_repeated_rows_and_nulls(spark, parts):
    schema = "k string, a int, b int"
    left = spark.createDataFrame([("x", 1, None), ("x", 1, None), ("y", None, 2), (None, 3, 3), ("same", 0, 0)], schema)
    right = spark.createDataFrame([("x", 1, None), ("x", None, 1), ("y", None, 2), (None, 3, 3), (None, 3, 3), ("same", 0, 0)], schema)
    found = {(r.k, r.a, r.b, r.side, r.surplus) for r in d.differences(left, right, ["k"], parts).collect()}
    assert found == {("x", 1, None, "left", 1), ("x", None, 1, "right", 1), (None, 3, 3, "right", 1)}


def test_no_rows_and_other_columns(spark):
    rows = spark.createDataFrame([("x", 1)], "k string, a int")
    assert d.differences(rows.limit(0), rows.limit(0), ["k"]).collect() == []
    assert [tuple(r) for r in d.differences(rows, rows.limit(0), ["k"]).collect()] == [("x", 1, "left", 1)]
    with pytest.raises(ValueError):
        d.differences(rows, rows.withColumnRenamed("a", "b"), ["k"])
