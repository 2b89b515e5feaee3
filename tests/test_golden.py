"""Published totals on the published inputs."""

from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import quality
from millrace.plans import daily_sales, people
from tests import fixtures


def sales_inputs(spark):
    return (
        spark.createDataFrame(fixtures.TRANSACTIONS, schemas.RAW_TRANSACTIONS),
        spark.createDataFrame(fixtures.SALES_CUSTOMERS, schemas.RAW_CUSTOMERS),
        spark.createDataFrame(fixtures.SALES_PRODUCTS, schemas.RAW_PRODUCTS),
        [F.col(c).asc() for c in ("customer_id", "product_id", "qty", "txn_date", "payment_status")],
    )


def test_daily_sales(spark):
    checked = daily_sales.checked_transactions(*sales_inputs(spark))
    assert {r.outcome: r.n for r in quality.quarantine_counts(checked).collect()} == fixtures.REJECTS
    sales = daily_sales.typed_sales(checked)
    assert {r.city: r.total_revenue for r in daily_sales.revenue_by_city(sales).collect()} == fixtures.CITY_REVENUE
    daily = daily_sales.daily_by_category(sales)
    assert quality.same_contract(daily.select(*schemas.DAILY_SALES.names), schemas.DAILY_SALES)
    rows = daily.orderBy("txn_date", "category").collect()
    assert len(rows) == 9
    assert (str(rows[0].txn_date), rows[0].category, rows[0].orders, rows[0].units_sold, rows[0].total_revenue) == (
        "2025-01-05", "Accessories", 1, 2, 1000.0,
    )


def test_daily_sales_job_writes_and_reconciles(spark, tmp_path):
    counts = daily_sales.run(spark, *sales_inputs(spark), out=str(tmp_path))
    assert counts == daily_sales.Reconciliation(raw=16, unique=15, valid=9, rejected=6)
    rejected = spark.read.csv(f"{tmp_path}/rejected", header=True)
    assert rejected.count() == 6
    assert "city" not in rejected.columns
    january = spark.read.parquet(f"{tmp_path}/daily_sales").filter("year = 2025 AND month = 1")
    assert january.count() == 5


def test_missing_payment_status_is_valid(spark):
    raw, customers, products, prefer = sales_inputs(spark)
    unpaid = raw.filter("txn_id = 'T001'").withColumn("payment_status", F.lit(None).cast("string"))
    checked = daily_sales.checked_transactions(unpaid, customers, products, prefer)
    assert checked.first().reject_reason is None


def test_impossible_date_passes_the_pattern_but_has_no_day(spark):
    raw, customers, products, prefer = sales_inputs(spark)
    odd = raw.filter("txn_id = 'T001'").withColumn("txn_date", F.lit("2025-13-45"))
    sales = daily_sales.typed_sales(daily_sales.checked_transactions(odd, customers, products, prefer))
    assert sales.first().txn_date is None


def test_departments(spark):
    staff = spark.createDataFrame(fixtures.STAFF, schemas.STAFF)
    totals = staff.agg(F.count("id"), F.sum("salary"), F.round(F.avg("salary"), 2)).first()
    assert tuple(totals) == (12, 830000, 69166.67)
    bills = spark.createDataFrame(fixtures.BILLING, schemas.BILLING)
    metrics = {r.department: r for r in people.department_metrics(bills).collect()}
    assert sum(r.revenue for r in metrics.values()) == 8725000
    assert metrics["Cardiology"].revenue == 3610000
    assert round(metrics["Orthopedics"].revenue_per_patient, 2) == 19475.52
    monthly = {r.department: r for r in people.monthly_by_department(bills, [1, 2, 3]).collect()}
    assert monthly["Emergency"]["3"] == 0 and monthly["Cardiology"]["3"] == 1200000


def test_customers(spark):
    customers = spark.createDataFrame(fixtures.CUSTOMERS, schemas.CUSTOMERS)
    orders = spark.createDataFrame(fixtures.ORDERS, schemas.ORDERS_JSON)
    summary = {r.customer_id: r for r in people.customer_summary(customers, orders).collect()}
    assert (summary["C001"].total_orders, summary["C001"].total_spent, summary["C001"].avg_order) == (3, 1369.5, 456.5)
    assert (summary["C005"].total_orders, summary["C005"].total_spent, summary["C005"].avg_order) == (0, 0.0, 0.0)
    cities = people.revenue_by(people.customer_summary(customers, orders), "city")
    assert {r.city: (r.customers, r.revenue) for r in cities.collect()} == {
        "Hyderabad": (2, 46369.5), "Mumbai": (1, 1520.0), "Delhi": (1, 949.99), "Bengaluru": (1, 0.0),
    }


def test_payroll(spark):
    staff = spark.createDataFrame(fixtures.PAYROLL_STAFF, schemas.EMPLOYEES)
    paid = {r.id: (float(r.gross), float(r.tax), float(r.net)) for r in people.payroll(staff).collect()}
    assert paid[1] == (132000.0, 39600.0, 92400.0)
    assert paid[4] == (53760.0, 10752.0, 43008.0)
    assert paid[5] == (44100.0, 4410.0, 39690.0)
