"""Exact sums equal math.fsum to the bit, whatever the order and the partitioning."""

import math
import random
import struct

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions import exact
from millrace.functions.money import mean, total, total_of


def summed(spark, values, partitions=4):
    rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
    return rows.agg(total("x").alias("s")).first().s


def bits(value):
    return None if value is None else struct.pack("<d", value)


CASES = {
    "thirds": [1 / 3] * 7,
    "decimals": [0.1, 0.2, 0.3, -0.6],
    "large and small": [1e15, 1e-9, -1e15, 1 / 3, 1e-9],
    "cancelling": [1e18, 1.0, -1e18, 2**-80, -1.0],
    "ties to even": [2.0**53, 1.0, 0.0],
    "above a tie": [2.0**53, 1.0, 2.0**-70],
    "below a tie": [2.0**53, 1.0, -(2.0**-70)],
    "odd tie": [2.0**53 + 2, 1.0],
    "negative": [-(2.0**53), -1.0, -(2.0**-60)],
    "nothing left": [1e10, -1e10],
    "single": [-5e-20],
    "edges": [2.0**63, -(2.0**63), 2.0**-134, 2.0**-134],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_fsum(spark, name):
    values = CASES[name]
    expected = math.fsum(values)
    assert bits(summed(spark, values)) == bits(expected)
    assert bits(summed(spark, values[::-1], 1)) == bits(expected)


def test_random_groups(spark):
    rng = random.Random(3)
    rows = []
    for k in range(300):
        scale = rng.choice([(-20, 15), (-9, 0), (0, 18), (2, 3)])
        rows += [(k, rng.choice([-1, 1]) * rng.random() * 10 ** rng.uniform(*scale)) for _ in range(rng.randint(1, 60))]
    rng.shuffle(rows)
    got = spark.createDataFrame(rows, "k long, x double").repartition(7).groupBy("k").agg(total("x").alias("s"), mean("x").alias("m"))
    held = {}
    for k, x in rows:
        held.setdefault(k, []).append(x)
    for row in got.collect():
        assert bits(row.s) == bits(math.fsum(held[row.k]))
        assert row.m == math.fsum(held[row.k]) / len(held[row.k])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(min_value=-1e19, max_value=1e19, allow_subnormal=False).filter(lambda x: x == 0 or abs(x) > 1e-24), min_size=1, max_size=20))
def test_any_double_of_usual_size(spark, values):
    assert summed(spark, values) == math.fsum(values)


def test_nulls_and_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    assert summed(spark, [None, None]) is None
    assert summed(spark, [None, 1.5]) == 1.5
    assert math.isnan(summed(spark, [1.0, nan]))
    assert summed(spark, [1.0, inf]) == inf and summed(spark, [1.0, -inf]) == -inf
    assert math.isnan(summed(spark, [inf, -inf]))
    # Beyond the exact range a sum is a plain one.
    assert summed(spark, [1e300, 1e300, 3.0]) == 2e300
    assert summed(spark, [1e-300, 2e-300]) == 3e-300


def test_parts_merge_in_steps(spark):
    values = [(k % 3, k % 5, (-1) ** k * (k / 3) ** 9) for k in range(400)]
    rows = spark.createDataFrame(values, "a long, b long, x double")
    steps = rows.groupBy("a", "b").agg(*exact.parts(F.col("x")).named("p_"))
    steps = steps.groupBy("a").agg(*exact.merged("p_").named("q_"))
    assert steps.agg(exact.merged("q_").rounded().alias("s")).first().s == math.fsum(x for _, _, x in values)


def test_decimals_are_summed_as_they_are(spark):
    rows = spark.sql("SELECT CAST(x AS DECIMAL(20,3)) AS x FROM VALUES ('0.1'), ('0.2'), ('12345678901234567.005') AS t(x)")
    assert str(rows.agg(total_of(rows, "x").alias("s")).first().s) == "12345678901234567.305"
