"""The given tables in the roles the jobs expect.

The tables are clean, so defects are planted by fixed expressions over every
row; the SQL side repeats the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.plans import bookings
from millrace.sources.tables import Tables


def level_lines(t: Tables) -> DataFrame:
    """``LEVEL message`` log lines from events."""
    return t.events.select(F.concat_ws(" ", F.upper("event_type"), "props").alias("value"))


def stamped_line(ts: str = "ts") -> Column:
    """``DATE TIME LEVEL message`` log line of an event."""
    stamp = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return F.concat_ws(" ", stamp, F.upper("event_type"), "props")


# --- order lines (CSV text with 7 fields) -----------------------------------

ORDER_FIELDS_SQL = """
      SELECT CASE WHEN l_partkey % 97 = 0 THEN '' ELSE concat(l_orderkey, '-', l_linenumber) END AS order_id,
             CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
             CASE WHEN l_partkey % 89 = 0 THEN '0' WHEN l_partkey % 83 = 0 THEN 'many'
                  ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS qty,
             CASE WHEN l_partkey % 79 = 0 THEN 'NaN' WHEN l_partkey % 73 = 0 THEN '-1'
                  ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
             strftime(l_shipdate, '%Y-%m-%d') AS order_date,
             CASE WHEN l_returnflag = 'R' THEN 'Cancelled' ELSE 'Delivered' END AS status,
             l_partkey % 71 = 0 AS short_line
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _order_rows(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def order_lines(t: Tables) -> DataFrame:
    """Order lines with planted defects: no id, bad numbers, a field short."""
    joined = _order_rows(t)
    part = F.col("l_partkey")
    order_id = F.when(part % 97 == 0, "").otherwise(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))
    )
    qty = (
        F.when(part % 89 == 0, "0")
        .when(part % 83 == 0, "many")
        .otherwise(F.col("l_quantity").cast("long").cast("string"))
    )
    price = (
        F.when(part % 79 == 0, "NaN")
        .when(part % 73 == 0, "-1")
        .otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
    )
    day = F.col("l_shipdate").cast("date").cast("string")
    status = F.when(F.col("l_returnflag") == "R", "Cancelled").otherwise("Delivered")
    head = F.concat_ws(" , ", order_id, F.col("o_custkey"), part, qty, price, day)
    line = F.when(part % 71 == 0, head).otherwise(F.concat_ws(",", head, status))
    return joined.select(line.alias("value"))


# --- raw transactions -------------------------------------------------------

TRANSACTIONS_SQL = """
      SELECT concat(l_orderkey, '-', l_linenumber) AS txn_id,
             CASE WHEN o_custkey % 97 = 0 THEN NULL WHEN o_custkey % 89 = 0 THEN ' '
                  WHEN o_custkey % 83 = 0 THEN concat('X', o_custkey)
                  ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
             CASE WHEN l_partkey % 79 = 0 THEN 'no-such-part' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
             CASE WHEN l_partkey % 73 = 0 THEN '0' WHEN l_partkey % 71 = 0 THEN 'abc'
                  ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS qty,
             CASE WHEN l_partkey % 67 = 0 THEN 'spring'
                  ELSE strftime(l_shipdate, '%Y-%m-%d') END AS txn_date,
             CASE WHEN o_orderstatus = 'F' THEN 'PAID' WHEN o_orderstatus = 'O' THEN 'FAILED' END
               AS payment_status
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

TRANSACTION_PREFERENCE = ("txn_date", "product_id", "qty", "customer_id", "payment_status")


def raw_transactions(t: Tables) -> DataFrame:
    """Text transactions with planted defects; ids repeat in the given data."""
    joined = _order_rows(t)
    customer, part = F.col("o_custkey"), F.col("l_partkey")
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("txn_id"),
        F.when(customer % 97 == 0, F.lit(None))
        .when(customer % 89 == 0, " ")
        .when(customer % 83 == 0, F.concat(F.lit("X"), customer))
        .otherwise(customer.cast("string"))
        .alias("customer_id"),
        F.when(part % 79 == 0, "no-such-part").otherwise(part.cast("string")).alias("product_id"),
        F.when(part % 73 == 0, "0")
        .when(part % 71 == 0, "abc")
        .otherwise(F.col("l_quantity").cast("long").cast("string"))
        .alias("qty"),
        F.when(part % 67 == 0, "spring")
        .otherwise(F.col("l_shipdate").cast("date").cast("string"))
        .alias("txn_date"),
        F.when(F.col("o_orderstatus") == "F", "PAID")
        .when(F.col("o_orderstatus") == "O", "FAILED")
        .alias("payment_status"),
    )


def transaction_preference():
    return [F.col(name).asc_nulls_first() for name in TRANSACTION_PREFERENCE]


def sales_customers(t: Tables) -> DataFrame:
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("segment"),
    )


def sales_products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )


CHECKED_SQL = f"""
    WITH raw AS ({TRANSACTIONS_SQL}),
    unique_txn AS (
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY txn_id
                    ORDER BY {", ".join(f"{c} NULLS FIRST" for c in TRANSACTION_PREFERENCE)}) AS rn FROM raw)
      WHERE rn = 1),
    checked AS (
      SELECT u.*, c_name AS customer_name, n_name AS city, p_name AS product_name, p_type AS category,
             p_retailprice AS unit_price,
             CASE WHEN customer_id IS NULL OR trim(customer_id) = '' THEN 'missing_customer'
                  WHEN c_name IS NULL THEN 'unknown_customer'
                  WHEN p_name IS NULL THEN 'unknown_product'
                  WHEN TRY_CAST(qty AS BIGINT) IS NULL OR TRY_CAST(qty AS BIGINT) <= 0 THEN 'invalid_qty'
                  WHEN NOT regexp_matches(txn_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN 'invalid_date'
                  WHEN payment_status <> 'PAID' THEN 'payment_not_paid' END AS reject_reason
      FROM unique_txn u
      LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey) ON customer_id = CAST(c_custkey AS VARCHAR)
      LEFT JOIN part ON product_id = CAST(p_partkey AS VARCHAR))"""


# --- shop -------------------------------------------------------------------


def shop_products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
    )


def shop_customers(t: Tables) -> DataFrame:
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("  "), F.lower("n_name"), F.lit("\t")).alias("country"),
    )


SHOP_SQL = f"""
    WITH src AS ({ORDER_FIELDS_SQL}),
    valid AS (
      SELECT order_id, customer_id, product_id, TRY_CAST(qty AS BIGINT) AS qty,
             TRY_CAST(price AS DOUBLE) AS price, order_date, lower(status) AS status
      FROM src
      WHERE NOT short_line AND order_id <> '' AND TRY_CAST(qty AS BIGINT) > 0
        AND TRY_CAST(price AS DOUBLE) > 0 AND NOT isnan(TRY_CAST(price AS DOUBLE))),
    orders_once AS (
      SELECT *, row_number() OVER (PARTITION BY order_id
                  ORDER BY customer_id, product_id, qty, price, order_date, status) AS rn FROM valid),
    enriched AS (
      SELECT order_id, customer_id, p_name AS product_name, p_type AS category, upper(n_name) AS country,
             CAST(order_date AS DATE) AS order_date, substr(order_date, 1, 7) AS order_month,
             qty * CAST(price AS DECIMAL(12,2)) AS revenue
      FROM orders_once JOIN part ON product_id = CAST(p_partkey AS VARCHAR)
           JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR) JOIN nation ON c_nationkey = n_nationkey
      WHERE rn = 1 AND status <> 'cancelled')"""


# --- staff, bills, risk -----------------------------------------------------


def staff(t: Tables) -> DataFrame:
    """Customers as employees: twelve times the balance, bonus by nation."""
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("dept"),
        (F.col("c_acctbal").cast("decimal(12,2)") * 12).cast("double").alias("salary"),
        F.col("c_nationkey").cast("double").alias("bonus_pct"),
    )


PAYROLL_SQL = """
    WITH staff AS (
      SELECT c_custkey AS id, c_name AS name, c_mktsegment AS dept,
             CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 12 AS DECIMAL(14,2)) AS salary,
             CAST(c_nationkey AS DECIMAL(6,2)) AS bonus_pct FROM customer),
    grossed AS (SELECT *, salary + salary * (bonus_pct * 0.01) AS g FROM staff),
    taxed AS (SELECT *, g * CASE WHEN g > 100000 THEN CAST(0.30 AS DECIMAL(6,4))
                                 WHEN g > 50000 THEN CAST(0.20 AS DECIMAL(6,4))
                                 ELSE CAST(0.10 AS DECIMAL(6,4)) END AS x FROM grossed),
    payroll AS (SELECT id, name, dept, CAST(round(g, 2) AS DOUBLE) AS gross,
                       CAST(round(x, 2) AS DOUBLE) AS tax, round(g - x, 2) AS net FROM taxed)"""


def bills(t: Tables) -> DataFrame:
    """Order lines as hospital bills: part type as department."""
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("l_orderkey").alias("bill_id"),
        F.col("p_type").alias("department"),
        F.month("l_shipdate").alias("month"),
        F.col("l_quantity").cast("int").alias("patients"),
        F.col("l_extendedprice").alias("amount"),
    )


def risk_transactions(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("customer_id"),
        F.col("value").alias("amount"),
    )


# --- bookings ---------------------------------------------------------------

BOOKINGS_SQL = """
      SELECT * FROM (
        SELECT CAST(user_id AS VARCHAR) AS booking_id, CAST(event_id % 28 AS VARCHAR) AS item_id,
               event_id % 5 + 1 AS seats,
               CASE WHEN event_type = 'error' THEN 'CANCEL' WHEN event_type IN ('purchase', 'signup') THEN 'BOOK'
                    ELSE upper(event_type) END AS action,
               ts AS event_time, event_id
        FROM events)
      WHERE action IN ('BOOK', 'CANCEL') AND item_id IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation)"""


def booking_events(events: DataFrame) -> DataFrame:
    """Events as bookings: errors cancel, purchases and sign-ups book; the rest are actions that no booking knows."""
    kind = F.col("event_type")
    action = F.when(kind == "error", "CANCEL").when(kind.isin("purchase", "signup"), "BOOK").otherwise(F.upper(kind))
    mapped = events.select(
        F.col("user_id").cast("string").alias("booking_id"),
        (F.col("event_id") % 28).cast("string").alias("item_id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("seats"),
        action.alias("action"),
        F.col("ts").alias("event_time"),
        "event_id",
    )
    return bookings.known_actions(mapped)


def inventory(t: Tables) -> DataFrame:
    """Nations as items, regions as item types."""
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.col("n_nationkey").cast("string").alias("item_id"),
        F.col("n_name").alias("item_name"),
        F.col("r_name").alias("item_type"),
        (F.col("n_nationkey") + 10).cast("int").alias("capacity"),
    )


# Fold the booking rules event by event. Each event sees the event before it
# and the last opening before it, which is all the rules depend on.
STATE_SQL = f"""
    WITH b AS ({BOOKINGS_SQL}),
    chained AS (SELECT *, lag(action) OVER (PARTITION BY booking_id ORDER BY event_time, event_id) AS prev FROM b),
    state AS (
      SELECT booking_id,
             arg_max(item_id, (event_time, event_id)) FILTER (WHERE action = 'BOOK' AND coalesce(prev, 'CANCEL') = 'CANCEL') AS item_id,
             arg_max(seats, (event_time, event_id)) FILTER (WHERE action = 'BOOK' AND coalesce(prev, 'CANCEL') = 'CANCEL') AS seats,
             CASE arg_max(action, (event_time, event_id)) WHEN 'BOOK' THEN 'BOOKED' ELSE 'CANCELLED' END AS status
      FROM chained GROUP BY 1 HAVING count(CASE WHEN action = 'BOOK' THEN 1 END) > 0)"""

OCCUPANCY_SQL = f"""{STATE_SQL},
    report AS (
      SELECT CAST(n_nationkey AS VARCHAR) AS item_id, n_name AS item_name, r_name AS item_type,
             CAST(n_nationkey + 10 AS BIGINT) AS capacity,
             CAST(coalesce(sum(CASE WHEN status = 'BOOKED' THEN seats END), 0) AS BIGINT) AS occupied,
             count(CASE WHEN status = 'CANCELLED' THEN 1 END) AS cancelled
      FROM nation JOIN region ON n_regionkey = r_regionkey
           LEFT JOIN state ON item_id = CAST(n_nationkey AS VARCHAR)
      GROUP BY ALL)"""
