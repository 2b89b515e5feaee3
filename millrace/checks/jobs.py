"""End-to-end jobs on the given tables."""

from pyspark.sql import functions as F

from millrace.checks import roles
from millrace.checks.registry import check
from millrace.functions import rules
from millrace.functions.money import total
from millrace.operators import joins, quality
from millrace.plans import bookings, daily_sales, people, reports, shop


def _checked(t):
    return daily_sales.checked_transactions(
        roles.raw_transactions(t),
        roles.sales_customers(t),
        roles.sales_products(t),
        roles.transaction_preference(),
    )


@check(
    "reject_reason",
    f"{roles.CHECKED_SQL} SELECT txn_id, customer_id, product_id, qty, reject_reason FROM checked",
)
def reject_reason(t):
    return _checked(t).select("txn_id", "customer_id", "product_id", "qty", "reject_reason")


@check(
    "quarantine_counts",
    f"""{roles.CHECKED_SQL}
    SELECT coalesce(reject_reason, 'valid') AS outcome, count(*) AS n FROM checked GROUP BY 1""",
)
def quarantine_counts(t):
    return quality.quarantine_counts(_checked(t))


@check(
    "daily_sales",
    f"""{roles.CHECKED_SQL}
    SELECT year(CAST(txn_date AS DATE)) AS year, month(CAST(txn_date AS DATE)) AS month, txn_date, category,
           count(DISTINCT txn_id) AS orders, CAST(sum(CAST(qty AS BIGINT)) AS BIGINT) AS units_sold,
           exact_sum(CAST(qty AS BIGINT) * CAST(unit_price AS DECIMAL(12,2))) AS total_revenue
    FROM checked WHERE reject_reason IS NULL GROUP BY 1, 2, 3, 4""",
)
def daily(t):
    return daily_sales.daily_by_category(daily_sales.typed_sales(_checked(t)))


@check(
    "revenue_by_city",
    f"""{roles.CHECKED_SQL}
    SELECT city, exact_sum(CAST(qty AS BIGINT) * CAST(unit_price AS DECIMAL(12,2))) AS total_revenue
    FROM checked WHERE reject_reason IS NULL GROUP BY 1""",
)
def revenue_by_city(t):
    return daily_sales.revenue_by_city(daily_sales.typed_sales(_checked(t)))


def _enriched(t):
    orders, *_ = shop.clean_orders(roles.order_lines(t))
    return shop.enriched_orders(orders, roles.shop_products(t), roles.shop_customers(t))


@check(
    "monthly_revenue",
    f"""{roles.SHOP_SQL}
    SELECT order_month, category, exact_sum(revenue) AS revenue, count(*) AS orders
    FROM enriched GROUP BY 1, 2""",
)
def monthly_revenue(t):
    return shop.monthly_revenue(_enriched(t))


@check(
    "country_revenue",
    f"""{roles.SHOP_SQL}
    SELECT country, exact_sum(revenue) AS revenue FROM enriched GROUP BY 1""",
)
def country_revenue(t):
    return _enriched(t).groupBy("country").agg(total("revenue").alias("revenue"))


@check(
    "top_products",
    f"""{roles.SHOP_SQL},
    sums AS (SELECT category, product_name, exact_sum(revenue) AS cat_revenue FROM enriched GROUP BY 1, 2)
    SELECT category, product_name, CAST(cat_revenue AS DOUBLE) AS cat_revenue, rank
    FROM (SELECT *, dense_rank() OVER (PARTITION BY category ORDER BY cat_revenue DESC) AS rank FROM sums)
    WHERE rank <= 3""",
)
def top_products(t):
    return shop.top_products(_enriched(t))


@check(
    "running_spend",
    f"""{roles.SHOP_SQL}
    SELECT customer_id, order_id, CAST(revenue AS DOUBLE) AS revenue,
           CAST(sum(revenue) OVER (PARTITION BY customer_id ORDER BY order_date, order_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_spend
    FROM enriched""",
)
def running_spend(t):
    return shop.running_spend(_enriched(t)).select("customer_id", "order_id", "revenue", "running_spend")


@check(
    "customer_tier",
    f"""{roles.SHOP_SQL},
    spent AS (SELECT customer_id, exact_sum(revenue) AS spend FROM enriched GROUP BY 1)
    SELECT customer_id, CAST(spend AS DOUBLE) AS spend,
           CASE WHEN spend >= {rules.TIER_BANDS[0][0]} THEN 'GOLD'
                WHEN spend >= {rules.TIER_BANDS[1][0]} THEN 'SILVER' ELSE 'BRONZE' END AS tier
    FROM spent""",
)
def customer_tier(t):
    return shop.customer_tiers(_enriched(t))


@check(
    "payroll",
    f"{roles.PAYROLL_SQL} SELECT id, name, dept, gross, tax, CAST(net AS DOUBLE) AS net FROM payroll",
)
def payroll(t):
    return people.payroll(roles.staff(t))


@check(
    "payroll_filter",
    f"{roles.PAYROLL_SQL} SELECT id, CAST(net AS DOUBLE) AS net FROM payroll WHERE net > 60000",
)
def payroll_filter(t):
    return people.payroll(roles.staff(t)).filter("net > 60000").select("id", "net")


@check(
    "payroll_summary",
    f"""{roles.PAYROLL_SQL}
    SELECT dept, count(id) AS employees, CAST(sum(net) AS DOUBLE) AS total_net FROM payroll GROUP BY 1""",
)
def payroll_summary(t):
    return people.payroll_summary(people.payroll(roles.staff(t)))


@check(
    "highest_net",
    f"""{roles.PAYROLL_SQL}
    SELECT id, dept, CAST(net AS DOUBLE) AS net FROM payroll ORDER BY net DESC, id LIMIT 1""",
)
def highest_net(t):
    paid = people.payroll(roles.staff(t))
    return paid.orderBy(F.desc("net"), F.asc("id")).limit(1).select("id", "dept", "net")


@check(
    "compensation",
    """
    WITH staff AS (
      SELECT c_custkey AS id, upper(c_name) AS name_upper,
             CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 12 AS DECIMAL(14,2)) AS salary,
             CAST(c_nationkey AS DECIMAL(6,2)) AS bonus_pct FROM customer),
    paid AS (SELECT *, round(salary * bonus_pct * 0.01, 2) AS bonus FROM staff)
    SELECT id, CAST(bonus AS DOUBLE) AS bonus, CAST(salary + bonus AS DOUBLE) AS total_comp,
           CASE WHEN salary >= 100000 THEN 'HIGH' WHEN salary >= 50000 THEN 'MEDIUM' ELSE 'LOW' END AS band,
           name_upper
    FROM paid""",
)
def compensation(t):
    return people.compensation(roles.staff(t))


@check(
    "dept_metrics",
    """
    WITH bills AS (SELECT l_orderkey AS bill_id, p_type AS department, CAST(l_quantity AS BIGINT) AS patients,
                          l_extendedprice AS amount
                   FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT department, count(bill_id) AS bills, CAST(sum(patients) AS BIGINT) AS patients,
           exact_sum(amount) AS revenue, exact_sum(amount) / count(bill_id) AS avg_bill,
           CAST(max(amount) AS DOUBLE) AS max_bill,
           exact_sum(amount) / CAST(sum(patients) AS DOUBLE) AS revenue_per_patient,
           exact_sum(amount) * 100 / (SELECT exact_sum(amount) FROM bills) AS share_pct
    FROM bills GROUP BY 1""",
)
def dept_metrics(t):
    return people.department_metrics(roles.bills(t))


@check(
    "risk_category",
    """
    WITH per_customer AS (
      SELECT user_id AS customer_id, count(event_id) AS txn_count,
             exact_sum(value) AS total_amount, max(value) AS max_txn
      FROM events GROUP BY 1)
    SELECT customer_id, txn_count, CAST(total_amount AS DOUBLE) AS total_amount, max_txn,
           CASE WHEN total_amount >= 50000 OR max_txn >= 40000 THEN 'HIGH'
                WHEN total_amount >= 5000 OR max_txn >= 1000 OR txn_count >= 10 THEN 'MEDIUM' ELSE 'LOW' END AS risk
    FROM per_customer""",
)
def risk_category(t):
    return people.customer_risk(roles.risk_transactions(t))


@check(
    "risk_counts",
    """
    WITH per_order AS (
      SELECT l_orderkey AS customer_id, count(*) AS txn_count,
             exact_sum(l_extendedprice) AS total_amount, max(l_extendedprice) AS max_txn
      FROM lineitem GROUP BY 1)
    SELECT CASE WHEN total_amount >= 50000 OR max_txn >= 40000 THEN 'HIGH'
                WHEN total_amount >= 5000 OR max_txn >= 1000 OR txn_count >= 10 THEN 'MEDIUM' ELSE 'LOW' END AS risk,
           count(*) AS n
    FROM per_order GROUP BY 1""",
)
def risk_counts(t):
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("customer_id"),
        F.col("l_linenumber").alias("txn_id"),
        F.col("l_extendedprice").alias("amount"),
    )
    return people.risk_counts(people.customer_risk(lines))


_TXN_LINES = """
    WITH src AS (
      SELECT event_id AS id, CASE WHEN event_id % 41 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS customer,
             event_type AS category, CASE WHEN event_id % 37 = 0 THEN -value ELSE value END AS amount,
             event_id % 43 = 0 AS bad_line
      FROM events),
    valid AS (SELECT * FROM src WHERE NOT bad_line AND customer <> '' AND amount > 0)"""


def _transaction_lines(t):
    key = F.col("event_id")
    customer = F.when(key % 41 == 0, "").otherwise(F.col("user_id").cast("string"))
    amount = F.when(key % 37 == 0, -F.col("value")).otherwise(F.col("value"))
    line = F.concat_ws(",", key, customer, F.col("event_type"), amount)
    return t.events.select(F.when(key % 43 == 0, "bad line").otherwise(line).alias("value"))


@check(
    "three_reports",
    f"""{_TXN_LINES},
    spend AS (SELECT customer, exact_sum(amount) AS total FROM valid GROUP BY 1
              ORDER BY total DESC, customer LIMIT 3)
    SELECT 'by_category' AS report, category AS label,
           exact_sum(amount) AS figure FROM valid GROUP BY 2
    UNION ALL SELECT 'top_customers', customer, total FROM spend
    UNION ALL SELECT 'average', 'all', exact_sum(amount) / count(*) FROM valid""",
)
def three_reports(t):
    made = reports.transaction_reports(_transaction_lines(t))

    def stacked(name, label, figure):
        return made[name].select(F.lit(name).alias("report"), label.alias("label"), figure.alias("figure"))

    return (
        stacked("by_category", F.col("category"), F.col("total"))
        .unionByName(stacked("top_customers", F.col("customer"), F.col("total")))
        .unionByName(stacked("average", F.lit("all"), F.col("average")))
    )


def _state(t):
    known = joins.with_partner(roles.booking_events(t.events), roles.inventory(t), "item_id")
    return bookings.booking_state(known, "date_trunc('minute', event_time)")


@check("booking_state", f"{roles.STATE_SQL} SELECT booking_id, item_id, seats, status FROM state")
def booking_state(t):
    return _state(t)


@check(
    "occupancy_report",
    f"""{roles.OCCUPANCY_SQL}
    SELECT *, capacity - occupied AS available,
           ((occupied * 2000 + capacity) // (capacity * 2)) / 10.0 AS occupancy_pct
    FROM report""",
)
def occupancy_report(t):
    return reports.occupancy(roles.inventory(t), _state(t))


@check(
    "occupancy_by_type",
    f"""{roles.OCCUPANCY_SQL}
    SELECT item_type, CAST(sum(capacity) AS BIGINT) AS total_capacity, CAST(sum(occupied) AS BIGINT) AS occupied,
           CAST(sum(capacity) - sum(occupied) AS BIGINT) AS available
    FROM report GROUP BY 1""",
)
def occupancy_by_type(t):
    return reports.occupancy_by_type(reports.occupancy(roles.inventory(t), _state(t)))


@check(
    "overbooked",
    f"""{roles.OCCUPANCY_SQL}
    SELECT item_id, item_name, capacity, occupied FROM report WHERE occupied > capacity""",
)
def overbooked(t):
    return reports.overbooked(reports.occupancy(roles.inventory(t), _state(t)))
