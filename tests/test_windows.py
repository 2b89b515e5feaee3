"""Bucketed windows equal plain ones, on data where one key owns a third."""

import pytest
from pyspark.sql import Window, functions as F

from millrace.operators import windows


@pytest.fixture(scope="module")
def skewed(spark):
    rows = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40))
        .alias("k"),
        F.when(F.col("id") % 13 > 0, F.xxhash64("id") % 97).alias("v"),
        F.when(F.col("id") % 7 > 0, F.xxhash64("id", F.lit(1)) % 1000).alias("x"),
    )
    return rows.cache()


def track(descending=False):
    return windows.Track(keys=["k"], order="v", bucket="floor(v / 10)", tiebreak=["id"], descending=descending)


def plain(descending, total):
    first = F.col("v").desc() if descending else F.col("v").asc()
    return Window.partitionBy("k").orderBy(first, "id") if total else Window.partitionBy("k").orderBy(first)


def same(left, right):
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


@pytest.mark.parametrize("descending", [False, True])
def test_ranking(skewed, descending):
    t = track(descending)
    same(
        windows.with_row_number(skewed, t, "n"),
        skewed.withColumn("n", (F.row_number().over(plain(descending, True))).cast("long")),
    )
    same(
        windows.with_rank(skewed, t, "n"),
        skewed.withColumn("n", F.rank().over(plain(descending, False)).cast("long")),
    )
    same(
        windows.with_dense_rank(skewed, t, "n"),
        skewed.withColumn("n", F.dense_rank().over(plain(descending, False)).cast("long")),
    )


@pytest.mark.parametrize("descending", [False, True])
def test_running_sum(skewed, descending):
    frame = plain(descending, True).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same(
        windows.with_running_sum(skewed, track(descending), F.col("x"), "s"),
        skewed.withColumn("s", F.sum(F.coalesce("x", F.lit(0))).over(frame)),
    )


def test_neighbours(skewed):
    same(
        windows.with_previous(skewed, track(), "x", "p"),
        skewed.withColumn("p", F.lag("x").over(plain(False, True))),
    )
    same(
        windows.with_next(skewed, track(), "x", "p"),
        skewed.withColumn("p", F.lead("x").over(plain(False, True))),
    )


@pytest.mark.parametrize("top", [windows.top_n, windows.top_n_with_ties])
def test_top_n_keeps_ties(skewed, top):
    expected = skewed.withColumn("rank", F.dense_rank().over(plain(True, False))).filter("rank <= 3")
    same(top(skewed, ["k"], "v", 3), expected)


def test_latest_per_key(skewed):
    expected = skewed.withColumn("n", F.row_number().over(plain(True, True))).filter("n = 1").drop("n")
    same(windows.latest_per_key(skewed, ["k"], [F.desc("v"), F.asc("id")]), expected)
