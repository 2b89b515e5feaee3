"""Declared schemas of the feeds the jobs read."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(ddl: str) -> T.StructType:
    kinds = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "double": T.DoubleType(),
        "date": T.DateType(),
        "timestamp": T.TimestampType(),
    }
    fields = (part.split() for part in ddl.split(","))
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields])


LINES = _struct("value string")

CUSTOMERS = _struct("customer_id string, name string, city string, age int")
ORDERS_JSON = _struct("order_id long, customer_id string, category string, amount double")
EMPLOYEES = _struct("id int, name string, dept string, salary double, bonus_pct double")
STAFF = _struct("id int, name string, dept string, gender string, salary int")
BILLING = _struct(
    "bill_id int, department string, month int, service_type string, patients int, amount int"
)
POLICIES = _struct("customer_id int, policy_id string, policy_date date")
TRIPS = _struct("route string, trip_date date, passengers int")

# Raw feeds stay text until the quality step has judged them.
RAW_TRANSACTIONS = _struct(
    "txn_id string, customer_id string, product_id string, qty string, txn_date string, "
    "payment_status string"
)
RAW_CUSTOMERS = _struct("customer_id string, customer_name string, city string, segment string")
RAW_PRODUCTS = _struct("product_id string, product_name string, category string, unit_price double")

SHOP_CUSTOMERS = _struct("customer_id string, country string")
SHOP_PRODUCTS = _struct("product_id string, name string, category string")
ORDER_STREAM = _struct(
    "order_id string, customer_id string, product_id string, qty int, price double, "
    "event_time string"
)

BRANCH_RISK = _struct("branch_id string, branch_name string, city string, risk_level string")
INVENTORY = _struct("item_id string, item_name string, item_type string, capacity int")
BOOKING_STATE = _struct("booking_id string, item_id string, seats int, status string")
DAILY_SALES = _struct(
    "year int, month int, txn_date date, category string, orders long, units_sold long, "
    "total_revenue double"
)
