"""Aggregates, ordering and top-k."""

from pyspark.sql import functions as F

from millrace.checks.registry import check
from millrace.functions.money import discounted_total, mean, total, total_units, units
from millrace.operators import aggregates

_SUM = "exact_sum({0})"
_PRICE_SUM = _SUM.format("l_extendedprice")
_TOTAL_SUM = _SUM.format("o_totalprice")
_REVENUE = (
    "CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) "
    "* (1 - CAST(l_discount AS DECIMAL(6,4)))) AS DOUBLE)"
)


@check("agg_total", f"SELECT {_PRICE_SUM} AS total, exact_sum(l_extendedprice / 3) AS thirds FROM lineitem")
def agg_total(t):
    # A third of a price has as many decimals as a double can tell apart.
    return t.lineitem.agg(total("l_extendedprice").alias("total"), total(F.col("l_extendedprice") / 3).alias("thirds"))


@check(
    "sum_by_key",
    f"""
    SELECT l_partkey, {_PRICE_SUM} AS revenue,
           CAST(sum(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS weighted
    FROM lineitem GROUP BY 1""",
)
def sum_by_key(t):
    weighted = units("l_quantity", 2) * units("l_extendedprice", 2)
    return t.lineitem.groupBy("l_partkey").agg(
        total("l_extendedprice").alias("revenue"),
        total_units(weighted, 4).cast("double").alias("weighted"),
    )


@check(
    "account_balance",
    """
    SELECT user_id, count(*) AS entries, exact_sum(CASE WHEN event_type IN ('purchase', 'signup') THEN value ELSE -value END) AS balance
    FROM events GROUP BY 1""",
)
def account_balance(t):
    deposit = F.col("event_type").isin("purchase", "signup")
    signed = F.when(deposit, F.col("value")).otherwise(-F.col("value"))
    return t.events.groupBy("user_id").agg(
        F.count("*").alias("entries"), total(signed).alias("balance")
    )


@check("count_by_key", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def count_by_key(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"))


@check(
    "collect_by_key",
    """
    SELECT event_type, event_id // 1000 AS chunk, count(*) AS n,
           array_to_string(list_sort(list(user_id)), ',') AS users
    FROM events GROUP BY 1, 2""",
)
def collect_by_key(t):
    lists = aggregates.collect_in_chunks(t.events, ["event_type"], "user_id", "event_id")
    return lists.select(
        "event_type",
        "chunk",
        F.size("collected").cast("long").alias("n"),
        F.array_join(F.col("collected").cast("array<string>"), ",").alias("users"),
    )


@check(
    "count_sum_by_key",
    f"SELECT user_id, count(*) AS n, {_SUM.format('value')} AS amount FROM events GROUP BY 1",
)
def count_sum_by_key(t):
    return t.events.groupBy("user_id").agg(
        F.count("*").alias("n"), total("value").alias("amount")
    )


@check(
    "agg_global",
    f"""
    SELECT count(o_orderkey) AS orders, {_TOTAL_SUM} AS total, {_TOTAL_SUM} / count(o_totalprice) AS average,
           min(o_totalprice) AS lowest, max(o_totalprice) AS highest
    FROM orders""",
)
def agg_global(t):
    return t.orders.agg(
        F.count("o_orderkey").alias("orders"),
        total("o_totalprice").alias("total"),
        mean("o_totalprice").alias("average"),
        F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"),
    )


@check(
    "agg_distinct",
    """
    SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1""",
)
def agg_distinct(t):
    return t.orders.groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("customers"))


@check(
    "group_multi",
    f"""
    SELECT l_returnflag, l_linestatus, count(*) AS n, {_REVENUE} AS revenue,
           {_SUM.format("l_quantity")} AS quantity
    FROM lineitem GROUP BY 1, 2""",
)
def group_multi(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        discounted_total("l_extendedprice", "l_discount").alias("revenue"),
        total("l_quantity").alias("quantity"),
    )


@check(
    "having_df",
    f"""
    SELECT l_suppkey, {_PRICE_SUM} / count(l_extendedprice) AS average FROM lineitem
    GROUP BY 1 HAVING average > 38000""",
)
def having_df(t):
    grouped = t.lineitem.groupBy("l_suppkey").agg(mean("l_extendedprice").alias("average"))
    return grouped.filter("average > 38000")


@check(
    "having_sql",
    f"""
    SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders
    GROUP BY 1 HAVING total > 2500000 AND count(*) >= 10""",
)
def having_sql(t):
    return t.spark.sql(
        """
        SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM {orders} GROUP BY o_custkey
        HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) > 2500000 AND count(*) >= 10""",
        orders=t.orders,
    )


@check(
    "where_then_group",
    "SELECT l_shipdate.year() AS y, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1",
)
def where_then_group(t):
    returned = t.lineitem.filter("l_returnflag = 'R'")
    return returned.groupBy(F.year("l_shipdate").alias("y")).agg(F.count("*").alias("n"))


@check(
    "group_stats",
    """
    SELECT p_brand, min(p_retailprice) AS lowest, max(p_retailprice) AS highest,
           round(max(p_retailprice) - min(p_retailprice), 4) AS gap,
           round(stddev_samp(p_retailprice), 4) AS std_dev
    FROM part GROUP BY 1""",
)
def group_stats(t):
    stats = t.part.groupBy("p_brand").agg(*aggregates.spread(F.col("p_retailprice")))
    return stats.withColumns({c: F.round(c, 4) for c in ("gap", "std_dev")})


@check(
    "agg_conditional",
    """
    SELECT o_orderpriority,
           coalesce(exact_sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0) AS paid,
           count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS open_orders
    FROM orders GROUP BY 1""",
)
def agg_conditional(t):
    paid = total(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")))
    return t.orders.groupBy("o_orderpriority").agg(
        F.coalesce(paid, F.lit(0.0)).alias("paid"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"),
    )


@check(
    "share_of_total",
    f"""
    SELECT l_suppkey, {_PRICE_SUM} AS total,
           {_PRICE_SUM} * 100 / (SELECT {_PRICE_SUM} FROM lineitem) AS share_pct
    FROM lineitem GROUP BY 1""",
)
def share_of_total(t):
    return aggregates.share_of_total(t.lineitem, ["l_suppkey"], F.col("l_extendedprice"))


@check(
    "ratio_measure",
    f"""
    SELECT o_orderpriority, {_TOTAL_SUM} / count(DISTINCT o_custkey) AS revenue_per_customer
    FROM orders GROUP BY 1""",
)
def ratio_measure(t):
    grouped = t.orders.groupBy("o_orderpriority").agg(
        total("o_totalprice").alias("revenue"), F.count_distinct("o_custkey").alias("customers")
    )
    ratio = F.try_divide("revenue", F.col("customers").cast("double")).alias("revenue_per_customer")
    return grouped.select("o_orderpriority", ratio)


_MONTHS = list(range(1, 13))


@check(
    "pivot_month",
    "SELECT o_orderpriority, "
    + ", ".join(
        'coalesce(exact_sum(CASE WHEN month(o_orderdate) = {0} THEN o_totalprice END), 0) AS "{0}"'.format(m)
        for m in _MONTHS
    )
    + " FROM orders GROUP BY 1",
)
def pivot_month(t):
    dated = t.orders.withColumn("m", F.month("o_orderdate"))
    return aggregates.pivot_sum(dated, ["o_orderpriority"], "m", _MONTHS, F.col("o_totalprice"))


@check(
    "two_level_agg",
    f"""
    SELECT p_type, count(*) AS items, CAST(sum(lines) AS BIGINT) AS lines, max(revenue) AS best_item
    FROM (SELECT p_partkey, p_type, count(l_orderkey) AS lines,
                 coalesce({_PRICE_SUM}, 0) AS revenue
          FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY 1, 2)
    GROUP BY 1""",
)
def two_level_agg(t):
    per_item = t.lineitem.groupBy("l_partkey").agg(
        F.count("*").alias("lines"), total("l_extendedprice").alias("revenue")
    )
    items = t.part.join(per_item, F.col("p_partkey") == F.col("l_partkey"), "left")
    items = items.na.fill({"lines": 0, "revenue": 0.0})
    return items.groupBy("p_type").agg(
        F.count("*").alias("items"),
        F.sum("lines").alias("lines"),
        F.max("revenue").alias("best_item"),
    )


@check(
    "argmax_row",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 1""",
)
def argmax_row(t):
    best = aggregates.best_row(t.orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return best.select("o_orderkey", "o_custkey", "o_totalprice")


@check(
    "best_mean_row",
    """
    SELECT vec_id, list_sum([CAST(x AS DOUBLE) FOR x IN embedding]) / len(embedding) AS mean_value
    FROM embeddings ORDER BY mean_value DESC, vec_id LIMIT 1""",
)
def best_mean_row(t):
    means = t.embeddings.select("vec_id", aggregates.array_mean(F.col("embedding")).alias("mean_value"))
    return aggregates.best_row(means, [F.desc("mean_value"), F.asc("vec_id")])


@check(
    "sort_limit",
    """
    SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders
    ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 100""",
)
def sort_limit(t):
    order = [F.asc("o_orderpriority"), F.desc("o_totalprice"), F.asc("o_orderkey")]
    return t.orders.select("o_orderpriority", "o_totalprice", "o_orderkey").orderBy(*order).limit(100)


@check(
    "sort_all",
    """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey""",
)
def sort_all(t):
    # The unique tiebreak lets range partitioning cut through equal values.
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), F.asc("o_orderkey")
    )


@check(
    "top_customers",
    f"""
    SELECT o_custkey, {_TOTAL_SUM} AS total FROM orders GROUP BY 1
    ORDER BY total DESC, o_custkey LIMIT 3""",
)
def top_customers(t):
    spend = t.orders.groupBy("o_custkey").agg(total("o_totalprice").alias("total"))
    return spend.orderBy(F.desc("total"), F.asc("o_custkey")).limit(3)


@check("take_rows")
def take_rows(t):
    return t.orders.select("o_orderkey").limit(5)
