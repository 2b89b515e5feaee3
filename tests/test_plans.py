"""What Spark makes of the queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.operators import joins, windows
from millrace.operators.layout import plan_text

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
PYTHON_STEPS = ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan(spark, name):
    return plan_text(QUERIES[name](spark, FOLDER))


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "filter_and")
    assert "GreaterThan(o_totalprice,300000.0)" in text
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_key_filter_of_a_join_reaches_the_scan(spark):
    assert "IsNotNull(o_custkey)" in plan(spark, "join_inner")


@pytest.mark.parametrize(
    "name",
    sorted(n for n in QUERIES if not n.startswith("stream_") and n not in ("salary_band_udf", "scan_partition_pruned")),
)
def test_no_python_no_pairs(spark, name):
    text = plan(spark, name)
    assert not any(step in text for step in PYTHON_STEPS)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_sums_combine_before_the_shuffle(spark):
    text = plan(spark, "count_by_key")
    assert text.count("HashAggregate") >= 2
    assert "partial_count" in text


@pytest.mark.parametrize("name", ["top_words", "top_customers", "argmax_row", "sort_limit"])
def test_top_k_without_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


@pytest.mark.parametrize("name", ["latest_per_key", "dedupe_key", "top_products", "top_n_sql", "top_n_df"])
def test_rank_limit_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


def test_join_strategies(spark):
    assert "SortMergeJoin" in plan(spark, "join_merge_hint")
    assert "BroadcastHashJoin" in plan(spark, "join_broadcast_sql")
    assert "BroadcastHashJoin" in plan(spark, "join_broadcast")


def test_bucketed_window_moves_the_rows_once(spark):
    """Window and join share one exchange on key and bucket."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.read.parquet(f"{FOLDER}/orders.parquet")
        track = windows.Track(
            keys=["o_custkey"], order="o_orderdate", bucket="month(o_orderdate)", tiebreak=["o_orderkey"]
        )
        text = plan_text(windows.with_running_sum(rows, track, F.col("o_orderkey"), "s"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Once the rows; the summaries by bucket, by key and, for the join, by bucket.
    assert text.count("Exchange hashpartitioning") == 4


def test_aggregate_reuses_hash_partitioning(spark):
    text = plan(spark, "hash_partition_total")
    assert text.count("hashpartitioning(o_custkey") == 1


def test_anti_join_uses_distinct_keys(spark):
    left = spark.range(10)
    right = spark.range(100).select((F.col("id") % 3).alias("id"))
    text = plan_text(joins.without_partner(left, right, "id"))
    assert "LeftAnti" in text and "HashAggregate" in text
