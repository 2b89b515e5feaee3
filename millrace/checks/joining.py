"""Joins and lookups."""

from pyspark.sql import functions as F

from millrace.checks.registry import check
from millrace.functions import rules
from millrace.functions.money import total
from millrace.operators import joins
from millrace.plans import people, reports


@check(
    "join_inner",
    """
    SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_inner(t):
    joined = joins.match(t.orders, t.customer, {"o_custkey": "c_custkey"})
    return joined.select("o_orderkey", "c_name", "o_totalprice")


@check(
    "join_merge_hint",
    """
    SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def join_merge_hint(t):
    joined = t.orders.join(t.customer.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "c_name", "o_totalprice")


@check(
    "join_left",
    """
    SELECT o_orderkey, l_partkey, l_extendedprice
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def join_left(t):
    joined = joins.keep_all(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"})
    return joined.select("o_orderkey", "l_partkey", "l_extendedprice")


@check(
    "join_right",
    """
    SELECT event_id, value, c_custkey, c_mktsegment
    FROM events RIGHT JOIN customer ON user_id = c_custkey""",
)
def join_right(t):
    joined = joins.keep_all(t.customer, t.events, {"c_custkey": "user_id"})
    return joined.select("event_id", "value", "c_custkey", "c_mktsegment")


@check(
    "join_full",
    """
    SELECT doc_id, CAST(quality AS BIGINT) AS quality, vec_id, CAST(label AS BIGINT) AS label
    FROM labels FULL JOIN embeddings ON doc_id = vec_id""",
)
def join_full(t):
    joined = joins.keep_both(t.labels, t.embeddings, {"doc_id": "vec_id"})
    return joined.select("doc_id", "quality", "vec_id", "label")


@check(
    "join_alias",
    """
    SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, n.n_name AS nation_name
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def join_alias(t):
    c = t.customer.withColumnsRenamed({"c_name": "name", "c_nationkey": "nation"}).alias("c")
    n = t.nation.withColumnsRenamed({"n_name": "name", "n_nationkey": "nation"}).alias("n")
    return c.join(n, F.col("c.nation") == F.col("n.nation")).select(
        F.col("c.c_custkey").alias("customer_id"),
        F.col("c.name").alias("customer_name"),
        F.col("n.name").alias("nation_name"),
    )


@check(
    "join_anti",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def join_anti(t):
    lonely = joins.without_partner(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"})
    return lonely.select("o_orderkey", "o_custkey")


@check(
    "join_semi",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
)
def join_semi(t):
    active = joins.with_partner(t.customer, t.events, {"c_custkey": "user_id"})
    return active.select("c_custkey", "c_name")


@check(
    "left_join_isnull",
    """
    SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.doc_id IS NULL""",
)
def left_join_isnull(t):
    labelled = t.documents.join(t.labels.alias("l"), "doc_id", "left")
    return labelled.filter(F.col("l.quality").isNull()).select("doc_id", "lang")


@check(
    "join_using",
    """
    SELECT doc_id, source, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic
    FROM documents JOIN labels USING (doc_id)""",
)
def join_using(t):
    return t.documents.join(t.labels, "doc_id").select("doc_id", "source", "quality", "toxic")


@check(
    "join_broadcast",
    """
    SELECT n_name AS branch_name, r_name AS state, count(*) AS txns,
           exact_sum(o_totalprice) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2""",
)
def join_broadcast(t):
    branches = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("branch_id"),
        F.col("n_name").alias("branch_name"),
        F.col("r_name").alias("state"),
    )
    branches = joins.hinted_if_small(branches)
    fact = joins.match(t.orders, t.customer, {"o_custkey": "c_custkey"}).select(
        F.col("c_nationkey").alias("branch_id"), F.col("o_totalprice").alias("amount")
    )
    return reports.branch_totals(fact, branches, "branch_name", "state")


@check(
    "join_broadcast_sql",
    """
    SELECT r_name AS state, count(*) AS suppliers,
           CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1""",
)
def join_broadcast_sql(t):
    small = [name for name, frame in (("n", t.nation), ("r", t.region)) if joins.is_small(frame)]
    hint = f"/*+ BROADCAST({', '.join(small)}) */" if small else ""
    return t.spark.sql(
        f"""
        SELECT {hint} r.r_name AS state, count(*) AS suppliers,
               CAST(sum(CAST(s.s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM {{supplier}} s JOIN {{nation}} n ON s.s_nationkey = n.n_nationkey
             JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
        GROUP BY r.r_name""",
        supplier=t.supplier,
        nation=t.nation,
        region=t.region,
    )


@check(
    "range_modulo_join",
    """
    SELECT n_name AS branch_name, count(*) AS txns,
           exact_sum(l_extendedprice) AS total
    FROM lineitem JOIN nation ON l_orderkey % 25 = n_nationkey GROUP BY 1""",
)
def range_modulo_join(t):
    branches = t.nation.select(F.col("n_nationkey").alias("branch_id"), F.col("n_name").alias("branch_name"))
    fact = t.lineitem.select(
        (F.col("l_orderkey") % 25).cast("int").alias("branch_id"),
        F.col("l_extendedprice").alias("amount"),
    )
    return reports.branch_totals(fact, branches, "branch_name")


@check(
    "join_chain",
    f"""
    SELECT c_custkey, o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           coalesce(l_returnflag, '{rules.NO_PAYMENT}') AS status
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey
         LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def join_chain(t):
    # A customer without orders has no lines either, so only matched rows are joined on.
    ordered = joins.match(t.customer, t.orders, {"c_custkey": "o_custkey"})
    idle = joins.without_partner(t.customer, t.orders, {"c_custkey": "o_custkey"})
    paid = ordered.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    paid = paid.unionByName(idle, allowMissingColumns=True)
    status = F.coalesce("l_returnflag", F.lit(rules.NO_PAYMENT)).alias("status")
    return paid.select("c_custkey", "o_orderkey", "l_linenumber", status)


@check(
    "lookup_unknown",
    f"""
    SELECT coalesce(CAST(quality AS VARCHAR), '{rules.UNKNOWN}') AS quality, count(*) AS docs,
           CAST(sum(n_chars) AS BIGINT) AS chars
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""",
)
def lookup_unknown(t):
    master = t.labels.select("doc_id", F.col("quality").cast("string").alias("quality"))
    looked_up = joins.enrich(
        t.documents.select("doc_id", "n_chars"), master, "doc_id", {"quality": rules.UNKNOWN}
    )
    return looked_up.groupBy("quality").agg(
        F.count("*").alias("docs"), F.sum("n_chars").alias("chars")
    )


@check(
    "lookup_default",
    """
    SELECT doc_id, n_chars * coalesce(quality, 0) AS kept_chars
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def lookup_default(t):
    looked_up = joins.enrich(
        t.documents.select("doc_id", "n_chars"), t.labels, "doc_id", {"quality": 0}
    )
    return looked_up.select("doc_id", (F.col("n_chars") * F.col("quality")).alias("kept_chars"))


def _summary(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), "c_nationkey"
    )
    orders = t.events.select(F.col("user_id").alias("customer_id"), F.col("value").alias("amount"))
    return people.customer_summary(customers, orders)


@check(
    "customer_summary",
    """
    SELECT c_custkey AS customer_id, c_name AS name, count(event_id) AS total_orders,
           coalesce(exact_sum(value), 0) AS total_spent,
           CASE WHEN count(event_id) = 0 THEN 0
                ELSE exact_sum(value) / count(event_id) END AS avg_order
    FROM customer LEFT JOIN events ON c_custkey = user_id GROUP BY 1, 2""",
)
def customer_summary(t):
    return _summary(t).drop("c_nationkey")


@check(
    "region_revenue",
    """
    WITH spent AS (SELECT user_id, exact_sum(value) AS spent FROM events GROUP BY 1)
    SELECT n_name AS nation, count(c_custkey) AS customers, coalesce(exact_sum(spent), 0) AS revenue
    FROM nation JOIN customer ON n_nationkey = c_nationkey LEFT JOIN spent ON c_custkey = user_id
    GROUP BY 1""",
)
def region_revenue(t):
    per_nation = people.revenue_by(_summary(t), "c_nationkey")
    named = joins.match(per_nation, t.nation, {"c_nationkey": "n_nationkey"})
    return named.select(F.col("n_name").alias("nation"), "customers", "revenue")


@check(
    "join_semi_totals",
    """
    SELECT o_orderstatus, count(*) AS orders,
           exact_sum(o_totalprice) AS total
    FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    GROUP BY 1""",
)
def join_semi_totals(t):
    returned = t.lineitem.filter("l_returnflag = 'R'")
    touched = joins.with_partner(t.orders, returned, {"o_orderkey": "l_orderkey"})
    return touched.groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"), total("o_totalprice").alias("total")
    )
