"""Joins of bucketed tables shuffle nothing; hot keys lie beside the buckets and lose no row."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import buckets, layout


@pytest.fixture(scope="module")
def laid(spark):
    left = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 101 > 0, F.col("id") % 400).alias("k"), F.col("id").alias("a")
    )
    right = spark.range(0, 500, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("b"))
    right = right.union(spark.createDataFrame([(7, 1), (7, 2), (None, 3)], "k long, b long"))
    return left, right, buckets.lay_out({"left_side": left, "right_side": right}, "k", buckets=6, hot_rows=1000)


def test_hot_key_is_kept_apart(laid):
    left, right, out = laid
    assert {r.k for r in out["left_side"].hot().select("k").distinct().collect()} == {7}
    assert out["right_side"].hot().count() == 2
    assert out["left_side"].even().filter("k = 7").count() == 0
    assert sorted(map(str, out["left_side"].rows().collect())) == sorted(map(str, left.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_anti", "left_semi"])
def test_same_rows_as_a_plain_join(laid, how):
    left, right, out = laid
    expected = left.join(right, "k", how)
    found = out["left_side"].join(out["right_side"], how)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_no_exchange_between_buckets(spark, laid):
    out = laid[2]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = out["left_side"].even().join(out["right_side"].even(), "k")
        assert "Exchange" not in layout.plan_text(joined) and "SortMergeJoin" in layout.plan_text(joined)
        grouped = out["left_side"].even().groupBy("k").count()
        assert "Exchange" not in layout.plan_text(grouped)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
