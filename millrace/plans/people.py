"""Customer analytics, payroll, department metrics and customer risk."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from millrace.functions import bands, exact
from millrace.functions.money import total
from millrace.operators import aggregates


def customer_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders, spend and average per customer; customers without orders stay.

    Orders are summed per customer before the join, so a customer with very
    many orders meets the join as one row.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"), total("amount").alias("total_spent")
    )
    joined = customers.join(per_customer, "customer_id", "left")
    return joined.na.fill({"total_orders": 0, "total_spent": 0.0}).withColumn(
        "avg_order",
        F.coalesce(F.try_divide("total_spent", F.col("total_orders").cast("double")), F.lit(0.0)),
    )


def revenue_by(summary: DataFrame, *place: str) -> DataFrame:
    """Customers and revenue per place, from the per-customer summary."""
    return summary.groupBy(*place).agg(
        F.count("customer_id").alias("customers"), total("total_spent").alias("revenue")
    )


def payroll(staff: DataFrame) -> DataFrame:
    """Gross, tax and net pay, each rounded from unrounded figures."""
    salary = F.col("salary").cast("decimal(14,2)")
    bonus = F.col("bonus_pct").cast("decimal(6,2)") * F.lit(Decimal("0.01"))
    gross = salary + salary * bonus
    exact = staff.withColumn("__gross", gross).withColumn(
        "__tax", F.col("__gross") * bands.tax_rate(F.col("__gross"))
    )
    return exact.select(
        "id",
        "name",
        "dept",
        F.round("__gross", 2).alias("gross"),
        F.round("__tax", 2).alias("tax"),
        F.round(F.col("__gross") - F.col("__tax"), 2).alias("net"),
    )


def payroll_summary(paid: DataFrame) -> DataFrame:
    return paid.groupBy("dept").agg(
        F.count("id").alias("employees"), F.sum("net").cast("double").alias("total_net")
    )


def compensation(staff: DataFrame) -> DataFrame:
    """Bonus, total, salary band and upper-case name."""
    salary = F.col("salary").cast("decimal(14,2)")
    bonus = F.round(salary * F.col("bonus_pct").cast("decimal(6,2)") * F.lit(Decimal("0.01")), 2)
    return staff.select(
        "id",
        bonus.alias("bonus"),
        (salary + bonus).alias("total_comp"),
        bands.salary_band(F.col("salary")).alias("band"),
        F.upper("name").alias("name_upper"),
    )


def department_metrics(bills: DataFrame) -> DataFrame:
    """Bills, patients, revenue, averages and share per department.

    The grand total is a subquery over the grouped rows, whose shuffle it shares.
    """
    grouped = bills.groupBy("department").agg(
        F.count("bill_id").alias("bills"),
        F.sum("patients").alias("patients"),
        *exact.parts(F.col("amount")).named("__revenue"),
        F.max("amount").alias("max_bill"),
    )
    grand = grouped.select(exact.merged("__revenue").rounded()).scalar()
    grouped = grouped.withColumn("revenue", exact.held("__revenue").rounded())
    revenue = F.col("revenue")
    return grouped.select(
        "department",
        "bills",
        "patients",
        "revenue",
        F.try_divide(revenue, F.col("bills").cast("double")).alias("avg_bill"),
        "max_bill",
        F.try_divide(revenue, F.col("patients").cast("double")).alias("revenue_per_patient"),
        F.try_divide(revenue * 100, grand).alias("share_pct"),
    )


def monthly_by_department(bills: DataFrame, months: list[int]) -> DataFrame:
    return aggregates.pivot_sum(bills, ["department"], "month", months, F.col("amount"))


def customer_risk(transactions: DataFrame) -> DataFrame:
    """Risk label from total, largest and number of transactions."""
    per_customer = transactions.groupBy("customer_id").agg(
        F.count("txn_id").alias("txn_count"),
        total("amount").alias("total_amount"),
        F.max("amount").alias("max_txn"),
    )
    return per_customer.withColumn(
        "risk", bands.risk_category(F.col("total_amount"), F.col("max_txn"), F.col("txn_count"))
    )


def risk_counts(risk: DataFrame) -> DataFrame:
    return risk.groupBy("risk").agg(F.count("*").alias("n"))
