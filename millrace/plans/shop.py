"""E-commerce batch: clean order lines, monthly revenue, rankings, tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from millrace.functions import bands, rules
from millrace.functions.money import line_amount, money, total
from millrace.functions.text import strip
from millrace.operators import joins, quality, scans, sets, windows
from millrace.operators.layout import reused, written
from millrace.sinks.writers import write_partitioned, write_report

ORDER_LINE = quality.LineSpec(
    fields=(
        ("order_id", "string"),
        ("customer_id", "string"),
        ("product_id", "string"),
        ("qty", "int"),
        ("price", "double"),
        ("order_date", "string"),
        ("status", "string"),
    ),
    required=("order_id",),
    positive=("qty", "price"),
    lower=("status",),
)

EVERY_COLUMN = ("customer_id", "product_id", "qty", "price", "order_date", "status")


def clean_orders(lines: DataFrame, prefer: Sequence[Column] | None = None) -> tuple[DataFrame, Observation, Observation]:
    """Valid, unique, not cancelled orders, and counters of what fell out.

    The counters sit where a row is judged and fill in with the first action:
    ``total`` and ``bad`` lines, and ``cancelled`` orders. Cancelled orders are
    dropped after the duplicates, so an order whose surviving copy is cancelled
    is gone.
    """
    parsed, seen = quality.counted(
        quality.parse_delimited(lines, ORDER_LINE),
        "orders",
        total=F.count("*"),
        bad=F.count_if(~F.col("is_valid")),
    )
    prefer = prefer or [F.col(name).asc() for name in EVERY_COLUMN]
    unique = sets.one_per_key(quality.valid_only(parsed), ["order_id"], prefer)
    judged, dropped = quality.counted(unique, "unique_orders", cancelled=F.count_if(F.col("status") == rules.CANCELLED_ORDER))
    return judged.filter(F.col("status") != rules.CANCELLED_ORDER), seen, dropped


def enriched_orders(orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of known products and customers with month, revenue, country."""
    named = products.withColumnRenamed("name", "product_name")
    joined = joins.match(joins.match(orders, named, "product_id"), customers, "customer_id")
    day = F.col("order_date").try_cast("date")
    return joined.select(
        "order_id",
        "customer_id",
        "product_name",
        "category",
        F.upper(strip(F.col("country"))).alias("country"),
        day.alias("order_date"),
        F.date_format(day, "yyyy-MM").alias("order_month"),
        line_amount("qty", "price").alias("revenue"),
    )


def monthly_revenue(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("order_month", "category").agg(
        total("revenue").alias("revenue"), F.count("*").alias("orders")
    )


def top_products(enriched: DataFrame, n: int = 3) -> DataFrame:
    """Best products per category by revenue, ties share a rank."""
    sums = enriched.groupBy("category", "product_name").agg(total("revenue").alias("cat_revenue"))
    return windows.top_n(sums, ["category"], "cat_revenue", n)


def running_spend(enriched: DataFrame) -> DataFrame:
    """Each customer's spend so far; the order id settles equal dates.

    The orders are written first: drawing split points reads them twice, and
    they are parsed and joined once.
    """
    line = scans.Line(keys=["customer_id"], order=["order_date", "order_id"])
    return scans.running_sum(written(enriched, "enriched"), line, money("revenue"), "running_spend")


def customer_tiers(enriched: DataFrame, steps: Sequence[tuple[object, str]] = rules.TIER_BANDS) -> DataFrame:
    spend = enriched.groupBy("customer_id").agg(total("revenue").alias("spend"))
    return spend.withColumn("tier", bands.customer_tier(F.col("spend"), steps))


def run(
    spark: SparkSession, lines: DataFrame, products: DataFrame, customers: DataFrame, out: str
) -> dict[str, int]:
    """Tier report as CSV, monthly revenue as Parquet per month."""
    orders, seen, dropped = clean_orders(lines)
    with reused(enriched_orders(orders, products, customers)) as enriched:
        write_report(customer_tiers(enriched), f"{out}/customer_tiers")
        write_partitioned(monthly_revenue(enriched), f"{out}/monthly_revenue", ["order_month"])
    return {**seen.get, **dropped.get}
