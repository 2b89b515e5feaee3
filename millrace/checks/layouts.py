"""Partition layout and partitioned storage."""

from pyspark.sql import functions as F, types as T

from millrace.checks.registry import check
from millrace.functions.money import total
from millrace.operators import aggregates, buckets, differences, layout
from millrace.session import fresh_folder
from millrace.sinks.writers import write_partitioned
from millrace.sources import placed
from millrace.sources.readers import read_parquet


@check(
    "scan_partition_pruned",
    """
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS orders,
           exact_sum(o_totalprice) AS revenue,
           year(o_orderdate) AS year, month(o_orderdate) AS month
    FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) <= 6 GROUP BY ALL""",
)
def scan_partition_pruned(t):
    day = F.col("o_orderdate").cast("date")
    daily = (
        t.orders.groupBy(day.alias("day"))
        .agg(F.count("*").alias("orders"), total("o_totalprice").alias("revenue"))
        .withColumns({"year": F.year("day"), "month": F.month("day")})
    )
    path = fresh_folder(t.spark, "daily-orders")
    write_partitioned(daily, path, ["year", "month"])
    return read_parquet(t.spark, path, F.col("year") == 1997, F.col("month") <= 6)


@check("repartition_rows", "SELECT count(*) AS n FROM orders")
def repartition_rows(t):
    per_partition = aggregates.rows_per_partition(layout.spread_evenly(t.orders, 8))
    return per_partition.agg(F.sum("n").alias("n"))


@check("hash_partition_rows", "SELECT count(*) AS n FROM orders")
def hash_partition_rows(t):
    per_partition = aggregates.rows_per_partition(layout.spread_by(t.orders, "o_custkey", partitions=8))
    return per_partition.agg(F.sum("n").alias("n"))


@check("scan_partition_rows")
def scan_partition_rows(t):
    return aggregates.rows_per_partition(t.lineitem)


@check(
    "hash_partition_total",
    """
    SELECT o_custkey, count(*) AS n, max(o_totalprice) AS largest FROM orders GROUP BY 1""",
)
def hash_partition_total(t):
    # Combined before the shuffle, so a customer with very many orders is one row a task.
    combined = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("largest"))
    return layout.spread_by(combined, "o_custkey")


_RESTATED = "CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"


@check(
    "table_differences",
    f"""
    WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders),
    b AS (SELECT o_orderkey, o_custkey, {_RESTATED} AS o_totalprice FROM orders WHERE o_orderkey % 1009 <> 0)
    SELECT *, 'left' AS side, CAST(1 AS BIGINT) AS surplus FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
    UNION ALL SELECT *, 'right', 1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def table_differences(t):
    """Orders against a copy in which some are restated and some are missing."""
    left = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    right = left.filter("o_orderkey % 1009 <> 0").withColumn("o_totalprice", F.expr(_RESTATED))
    return differences.differences(left, right, ["o_orderkey"])


@check(
    "bucketed_join",
    """
    SELECT o_custkey AS custkey, count(*) AS n, exact_sum(o_totalprice) AS total, CAST(any_value(c_nationkey) AS BIGINT) AS nation
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1""",
)
def bucketed_join(t):
    """Orders and customers laid out by customer, joined bucket by bucket; only partial sums per customer are shuffled."""
    orders = t.orders.select(F.col("o_custkey").alias("custkey"), "o_totalprice")
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nation"))
    laid = buckets.lay_out({"orders": orders, "customers": customers}, "custkey", buckets=8)
    joined = laid["orders"].join(laid["customers"], "left")
    return joined.groupBy("custkey").agg(F.count("*").alias("n"), total("o_totalprice").alias("total"), F.max("nation").alias("nation"))


# Events as lines: a word for a number, a field too few, an empty line, a byte that is no UTF-8.
_LINES_SQL = f"""
    SELECT CASE WHEN event_id % 61 = 0 THEN '{placed.EMPTY}' WHEN event_id % 67 = 0 THEN '{placed.NOT_UTF8}'
                WHEN event_id % 53 = 0 OR event_id % 59 = 0 THEN '{placed.UNFIT}' ELSE 'fits' END AS outcome,
           CASE WHEN event_id % 61 = 0 THEN 0
                ELSE strlen(CAST(event_id AS VARCHAR)) + 1
                     + CASE WHEN event_id % 53 = 0 THEN 4 ELSE strlen(CAST(user_id AS VARCHAR)) END
                     + CASE WHEN event_id % 59 = 0 THEN 0 ELSE 1 + strlen(event_type) END
                     + CASE WHEN event_id % 67 = 0 THEN 1 ELSE 0 END END AS bytes,
           CASE WHEN outcome = 'fits' THEN user_id END AS user_id
    FROM events"""


@check(
    "placed_rejects",
    f"""
    SELECT outcome, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(user_id) AS BIGINT) AS users
    FROM ({_LINES_SQL}) GROUP BY 1""",
)
def placed_rejects(t):
    """Every line of a feed with planted defects is a record or a reject of its kind, byte for byte."""
    key, folder = F.col("event_id"), fresh_folder(t.spark, "placed")
    user = F.when(key % 53 == 0, "many").otherwise(F.col("user_id").cast("string"))
    kind = F.when(key % 59 != 0, F.col("event_type"))
    line = F.concat_ws(",", key.cast("string"), user, kind)
    line = F.when(key % 67 == 0, F.concat(line, F.unhex(F.lit("FF")).cast("string"))).otherwise(line)
    t.events.select(F.when(key % 61 == 0, "").otherwise(line).alias("value")).write.text(folder)
    schema = T.StructType().add("event_id", T.LongType()).add("user_id", T.LongType()).add("event_type", T.StringType())
    marked = placed.placed_csv(t.spark, folder, schema)
    outcome = F.coalesce("reason", F.lit("fits")).alias("outcome")
    fitting = F.when(F.col("reason").isNull(), F.col("record.user_id"))
    size = F.octet_length(F.col("value").cast("binary")).cast("long")
    return marked.groupBy(outcome).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"), F.sum(fitting).alias("users"))
