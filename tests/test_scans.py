"""Prefix scans equal plain windows, and spread a key that owns nine tenths of the rows."""

import pytest
from pyspark.sql import Window, functions as F

from millrace.operators import scans


@pytest.fixture(scope="module")
def skewed(spark):
    rows = spark.range(6000).select(
        F.col("id"),
        F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 30 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 70)).alias("k"),
        F.when(F.col("id") % 13 > 0, F.xxhash64("id") % 97).alias("v"),
        F.when(F.col("id") % 7 > 0, F.xxhash64("id", F.lit(1)) % 1000).alias("x"),
    )
    return rows.repartition(5).cache()


def line(descending=False, keys=("k",)):
    return scans.Line(keys=list(keys), order=["v", "id"], descending=descending, partitions=16)


def plain(descending, total=True, keys=("k",)):
    names = ["v", "id"] if total else ["v"]
    return Window.partitionBy(*keys).orderBy(*(F.col(n).desc() if descending else F.col(n).asc() for n in names))


def same(left, right):
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


@pytest.mark.parametrize("descending", [False, True])
def test_running_values(skewed, descending):
    t, w = line(descending), plain(descending)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same(scans.running_sum(skewed, t, F.col("x"), "s"), skewed.withColumn("s", F.sum(F.coalesce("x", F.lit(0))).over(upto)))
    same(scans.running_count(skewed, t, "n"), skewed.withColumn("n", F.row_number().over(w).cast("long")))
    same(scans.running_max(skewed, t, F.col("x"), "m"), skewed.withColumn("m", F.max("x").over(upto)))
    same(scans.running_min(skewed, t, F.col("x"), "m"), skewed.withColumn("m", F.min("x").over(upto)))


@pytest.mark.parametrize("descending", [False, True])
def test_neighbours(skewed, descending):
    t, w = line(descending), plain(descending)
    same(scans.previous(skewed, t, F.col("x"), "p"), skewed.withColumn("p", F.lag("x").over(w)))
    same(scans.following(skewed, t, F.col("x"), "p"), skewed.withColumn("p", F.lead("x").over(w)))


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_of_values_that_tie(skewed, descending):
    t, w = line(descending), plain(descending, total=False)
    same(scans.rank(skewed, t, ["v"], "r"), skewed.withColumn("r", F.rank().over(w).cast("long")))
    same(scans.dense_rank(skewed, t, ["v"], "r"), skewed.withColumn("r", F.dense_rank().over(w).cast("long")))


def test_several_keys_no_keys_and_no_rows(spark, skewed):
    keyed = skewed.withColumn("b", F.col("id") % 2)
    upto = plain(False, keys=("k", "b")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same(scans.running_sum(keyed, line(keys=("k", "b")), F.col("x"), "s"), keyed.withColumn("s", F.sum(F.coalesce("x", F.lit(0))).over(upto)))
    whole = Window.orderBy("v", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same(scans.running_sum(skewed, line(keys=()), F.col("x"), "s"), skewed.withColumn("s", F.sum(F.coalesce("x", F.lit(0))).over(whole)))
    assert scans.running_sum(skewed.limit(0), line(), F.col("x"), "s").collect() == []


def test_a_hot_key_is_spread(spark, skewed):
    """Nine tenths of the rows have one key; no task holds more than twice the median."""
    ranged = scans._Ranged(skewed, line())
    sizes = sorted(r["count"] for r in ranged.rows.groupBy("__part").count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    hot = ranged.rows.filter("k = 'hot'").select("__part").distinct().count()
    assert hot >= 14
