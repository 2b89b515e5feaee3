"""Daily sales: clean raw transactions, quarantine bad ones, report revenue."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions import rules
from millrace.functions.money import line_amount, total
from millrace.operators import joins, quality, sets
from millrace.sinks.writers import write_csv, write_partitioned

def reject_rules() -> list[tuple[str, Column]]:
    """What makes a transaction unusable, in order of precedence.

    A missing payment status does not reject: only a known status other than
    paid does.
    """
    c = F.col
    quantity = c("qty").try_cast("int")
    return [
        ("missing_customer", c("customer_id").isNull() | (F.trim("customer_id") == "")),
        ("unknown_customer", c("customer_name").isNull()),
        ("unknown_product", c("product_name").isNull()),
        ("invalid_qty", quantity.isNull() | (quantity <= 0)),
        ("invalid_date", c("txn_date").isNull() | ~c("txn_date").rlike(rules.DATE_PATTERN)),
        ("payment_not_paid", c("payment_status").isNotNull() & (c("payment_status") != rules.PAID)),
    ]


def checked_transactions(
    raw: DataFrame, customers: DataFrame, products: DataFrame, prefer: Sequence[Column]
) -> DataFrame:
    """One row per transaction id, looked up and judged (``reject_reason``)."""
    unique = sets.one_per_key(raw, ["txn_id"], prefer)
    known = joins.enrich(joins.enrich(unique, customers, "customer_id"), products, "product_id")
    return known.withColumn("reject_reason", quality.reject_reason(reject_rules()))


def typed_sales(checked: DataFrame) -> DataFrame:
    """Accepted transactions with real types, revenue and date parts."""
    day = F.col("txn_date").try_cast("date")
    quantity = F.col("qty").try_cast("int")
    return quality.accepted(checked).select(
        "txn_id",
        day.alias("txn_date"),
        "customer_name",
        "city",
        "product_name",
        "category",
        quantity.alias("qty"),
        line_amount(quantity, "unit_price").alias("revenue"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
    )


def daily_by_category(sales: DataFrame) -> DataFrame:
    """Orders, units and revenue per day and category.

    Transaction ids are unique by now, so counting them needs no distinct.
    """
    return sales.groupBy("year", "month", "txn_date", "category").agg(
        F.count("txn_id").alias("orders"),
        F.sum("qty").alias("units_sold"),
        total("revenue").alias("total_revenue"),
    )


def revenue_by_city(sales: DataFrame) -> DataFrame:
    return sales.groupBy("city").agg(total("revenue").alias("total_revenue"))


@dataclass(frozen=True)
class Reconciliation:
    raw: int
    unique: int
    valid: int
    rejected: int


def run(
    spark: SparkSession,
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    prefer: Sequence[Column],
    out: str,
) -> Reconciliation:
    """Write quarantine, judged rows and daily sales below ``out``.

    The judged rows are written once, in folders per outcome, and every
    report reads them from there: nothing is computed twice and no executor
    has to hold them.
    """
    counted_raw, seen_raw = quality.counted(raw, "raw", rows=F.count("*"))
    checked, seen = quality.counted(
        checked_transactions(counted_raw, customers, products, prefer),
        "checked",
        rows=F.count("*"),
        rejected=F.count("reject_reason"),
    )
    judged = f"{out}/judged"
    outcome = F.when(F.col("reject_reason").isNull(), "valid").otherwise("rejected")
    checked.withColumn("outcome", outcome).write.mode("overwrite").partitionBy("outcome").parquet(judged)

    kept = spark.read.schema(checked.withColumn("outcome", outcome).schema).parquet(judged)
    # The quarantine file has the columns of the feed and the reason.
    write_csv(kept.filter("outcome = 'rejected'").select(*raw.columns, "reject_reason"), f"{out}/rejected")
    sales = typed_sales(kept.filter("outcome = 'valid'").drop("outcome"))
    write_partitioned(daily_by_category(sales), f"{out}/daily_sales", ["year", "month"])
    write_csv(revenue_by_city(sales), f"{out}/revenue_by_city")

    counts = seen.get
    return Reconciliation(
        raw=seen_raw.get["rows"],
        unique=counts["rows"],
        valid=counts["rows"] - counts["rejected"],
        rejected=counts["rejected"],
    )
