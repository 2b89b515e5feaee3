"""Window functions."""

from pyspark.sql import functions as F

from millrace.checks.registry import check
from millrace.functions.money import money
from millrace.operators import scans, windows

# Orders per customer by price.
_BY_PRICE = windows.Track(
    keys=["o_custkey"],
    order="o_totalprice",
    bucket="floor(o_totalprice / 100)",
    tiebreak=["o_orderkey"],
    descending=True,
)
_BY_DATE = scans.Line(keys=["o_custkey"], order=["o_orderdate", "o_orderkey"])


def _dated(t):
    """What a scan over orders carries."""
    return t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")


# Parts per type by size: many equal sizes, so ranks have real ties.
_BY_SIZE = windows.Track(
    keys=["p_type"],
    order="p_size",
    bucket="p_size",
    tiebreak=["p_partkey"],
    descending=True,
)


@check(
    "win_row_number",
    """
    SELECT o_orderkey, o_custkey,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
    FROM orders""",
)
def win_row_number(t):
    return windows.with_row_number(t.orders, _BY_PRICE, "rn").select("o_orderkey", "o_custkey", "rn")


@check(
    "win_rank",
    """
    SELECT p_partkey, p_type, CAST(p_size AS BIGINT) AS p_size, rank() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS rnk
    FROM part""",
)
def win_rank(t):
    return windows.with_rank(t.part, _BY_SIZE, "rnk").select("p_partkey", "p_type", "p_size", "rnk")


@check(
    "win_dense_rank",
    """
    SELECT p_partkey, p_type, CAST(p_size AS BIGINT) AS p_size,
           dense_rank() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS rnk
    FROM part""",
)
def win_dense_rank(t):
    return windows.with_dense_rank(t.part, _BY_SIZE, "rnk").select(
        "p_partkey", "p_type", "p_size", "rnk"
    )


@check(
    "latest_per_key",
    """
    SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, o_totalprice
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders) WHERE rn = 1""",
)
def latest_per_key(t):
    latest = windows.latest_per_key(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return latest.select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice"
    )


@check(
    "win_lag",
    """
    SELECT o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous
    FROM orders""",
)
def win_lag(t):
    return scans.previous(_dated(t), _BY_DATE, F.col("o_totalprice")).select("o_orderkey", "previous")


@check(
    "win_lead",
    """
    SELECT o_orderkey, lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next
    FROM orders""",
)
def win_lead(t):
    return scans.following(_dated(t), _BY_DATE, F.col("o_totalprice"), "next").select("o_orderkey", "next")


@check(
    "win_delta",
    """
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) - lag(CAST(o_totalprice AS DECIMAL(18,2)))
             OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DOUBLE) AS change
    FROM orders""",
)
def win_delta(t):
    exact = _dated(t).withColumn("price", money("o_totalprice"))
    placed = scans.previous(exact, _BY_DATE, F.col("price"))
    return placed.select("o_orderkey", (F.col("price") - F.col("previous")).alias("change"))


@check(
    "top_n_df",
    """
    SELECT * FROM (SELECT p_type, p_partkey, CAST(p_size AS BIGINT) AS p_size,
                          dense_rank() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS rnk FROM part)
    WHERE rnk <= 3""",
)
def top_n_df(t):
    parts = t.part.select("p_type", "p_partkey", "p_size")
    return windows.top_n_with_ties(parts, ["p_type"], "p_size", 3, "rnk")


@check(
    "top_n_sql",
    """
    SELECT o_orderstatus, o_orderkey, o_totalprice, rnk
    FROM (SELECT *, dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC) AS rnk FROM orders)
    WHERE rnk <= 3""",
)
def top_n_sql(t):
    return t.spark.sql(
        """
        SELECT * FROM (
          SELECT o.o_orderstatus, o.o_orderkey, o.o_totalprice, r.rnk
          FROM {orders} o JOIN (
            SELECT o_orderstatus, o_totalprice,
                   dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC) AS rnk
            FROM (SELECT DISTINCT o_orderstatus, o_totalprice FROM {orders})) r
          ON o.o_orderstatus = r.o_orderstatus AND o.o_totalprice = r.o_totalprice)
        WHERE rnk <= 3""",
        orders=t.orders,
    )


@check(
    "running_total",
    """
    SELECT o_orderkey, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
             PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_spend
    FROM orders""",
)
def running_total(t):
    run = scans.running_sum(_dated(t), _BY_DATE, money("o_totalprice"), "running_spend")
    return run.select("o_orderkey", "o_custkey", "running_spend")
