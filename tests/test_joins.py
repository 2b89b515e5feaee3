import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.operators import joins
from tests.test_windows import same


def tables(spark):
    fact = spark.range(600).select(
        F.col("id").alias("fact_id"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("fk"),
    )
    dim = spark.range(20, 70).select(F.col("id").alias("dk"), F.concat(F.lit("d"), "id").alias("name")).unionByName(
        spark.createDataFrame([(1, "one"), (None, "none")], "dk long, name string")
    )
    return fact, dim


def test_outer_joins_equal_spark(spark):
    fact, dim = tables(spark)
    on = F.col("fk") == F.col("dk")
    same(
        joins.keep_all(dim, fact, {"dk": "fk"}).select("fact_id", "fk", "dk", "name"),
        dim.join(fact, on, "left").select("fact_id", "fk", "dk", "name"),
    )
    same(joins.keep_both(fact, dim, {"fk": "dk"}), fact.join(dim, on, "full"))
    same(joins.without_partner(dim, fact, {"dk": "fk"}), dim.join(fact, on, "left_anti"))
    same(joins.with_partner(dim, fact, {"dk": "fk"}), dim.join(fact, on, "left_semi"))
    same(joins.match(fact, dim, {"fk": "dk"}), fact.join(dim, on))


def test_enrich_fills_misses(spark):
    fact, dim = tables(spark)
    filled = joins.enrich(fact, dim, {"fk": "dk"}, {"name": "UNKNOWN"})
    assert filled.count() == fact.count()
    assert filled.filter("name IS NULL").count() == 0
    assert filled.filter("name = 'UNKNOWN'").count() > 0


def test_broadcast_only_below_the_limit(spark):
    from millrace.operators.layout import plan_text

    # 50 rows of two numbers are 800 bytes.
    dim = spark.range(50).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("name"))
    fact = spark.range(1000).withColumnRenamed("id", "dk")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_text(fact.join(joins.hinted_if_small(dim), "dk"))
        assert "BroadcastHashJoin" not in plan_text(fact.join(joins.hinted_if_small(dim, 100), "dk"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_join_key_is_split(spark):
    """Adaptive skew join splits a key that owns most rows of a partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 400000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"), F.xxhash64("id").alias("v")
        )
        dim = spark.range(0, 6000).select(F.col("id").alias("k"), F.col("id").alias("name"))
        joined = joins.enrich(fact, dim, "k")
        result = joined.groupBy().agg(F.count("*").alias("n"), F.count("name").alias("m"))
        assert result.collect()[0] == (400000, 400000)
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_large_lookup_is_salted(spark, how):
    fact, dim = tables(spark)
    fact, dim = fact.withColumnRenamed("fk", "k"), dim.withColumnRenamed("dk", "k").filter("k IS NOT NULL")
    same(joins.look_up(fact, dim, "k", how, salts=4), fact.join(dim, "k", how))
    same(joins.look_up(fact, dim, "k", how), fact.join(dim, "k", how))


def test_join_tasks_stay_small(spark):
    # Adaptive execution joins no shuffle partitions beyond 16 MB, whatever the session came with; less stays.
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    try:
        for given, kept in (("64MB", 16 << 20), ("67108864b", 16 << 20), ("1g", 16 << 20), ("8m", 8 << 20), ("16k", 16 << 10)):
            spark.conf.set(name, given)
            session.configure(spark)
            assert session.size_in_bytes(spark.conf.get(name)) == kept
    finally:
        spark.conf.set(name, before)
