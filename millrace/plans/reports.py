"""Small reports: words, log lines, transactions, branches, bookings."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from millrace.functions import exact, rules, text
from millrace.functions.money import total
from millrace.operators import aggregates, quality
from millrace.operators.layout import reused

TRANSACTION_LINE = quality.LineSpec(
    fields=(("id", "int"), ("customer", "string"), ("category", "string"), ("amount", "double")),
    required=("customer",),
    positive=("amount",),
)


def top_words(documents: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent cleaned words, numbered."""
    counts = text.word_counts(documents, clean=True)
    return aggregates.numbered_top(counts, [F.desc("n"), F.asc("word")], n)


def error_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("value").startswith("ERROR"))


def level_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy(text.first_word(F.col("value")).alias("level")).agg(F.count("*").alias("n"))


def transaction_reports(lines: DataFrame) -> dict[str, DataFrame]:
    """Three reports of one cleaned feed; wrap ``valid`` in ``reused`` to share it."""
    valid = quality.valid_only(quality.parse_delimited(lines, TRANSACTION_LINE))
    return {"valid": valid, **reports_of(valid)}


def reports_of(valid: DataFrame) -> dict[str, DataFrame]:
    by_category = valid.groupBy("category").agg(total("amount").alias("total"))
    spend = valid.groupBy("customer").agg(total("amount").alias("total"))
    return {
        "by_category": by_category,
        "top_customers": spend.orderBy(F.desc("total"), F.asc("customer")).limit(3),
        "average": valid.agg(
            F.try_divide(total("amount"), F.count("*").cast("double")).alias("average")
        ),
    }


def write_transaction_reports(lines: DataFrame, out: str) -> None:
    valid = quality.valid_only(quality.parse_delimited(lines, TRANSACTION_LINE))
    with reused(valid) as kept:
        for name, report in reports_of(kept).items():
            report.write.mode("overwrite").parquet(f"{out}/{name}")


def branch_totals(fact: DataFrame, branches: DataFrame, *by: str) -> DataFrame:
    """Large fact with a branch table, totals per branch column.

    The fact is summed per branch id first, so a branch with most of the rows
    meets the join as one row however large the branch table is.
    """
    per_branch = fact.groupBy("branch_id").agg(
        F.count("*").alias("txns"), *exact.parts(F.col("amount")).named("__total")
    )
    joined = per_branch.join(branches, "branch_id")
    return joined.groupBy(*by).agg(
        F.sum("txns").alias("txns"), exact.merged("__total").rounded().alias("total")
    )


def occupancy(inventory: DataFrame, state: DataFrame) -> DataFrame:
    """Booked seats, free seats and cancellations per item, also for idle items; no percentage without seats.

    Bookings are summed per item before they meet the inventory.
    """
    per_item = state.groupBy("item_id").agg(
        F.sum(F.when(F.col("status") == rules.BOOKED, F.col("seats"))).alias("occupied"),
        F.count_if(F.col("status") == rules.CANCELLED).alias("cancelled"),
    )
    return occupancy_of(inventory, per_item)


def occupancy_of(inventory: DataFrame, per_item: DataFrame) -> DataFrame:
    """The report of ``occupancy`` from (item_id, occupied, cancelled); an item without a row is idle."""
    full = inventory.join(per_item, "item_id", "left").na.fill({"occupied": 0, "cancelled": 0})
    percent = F.try_divide(F.col("occupied") * F.lit(Decimal("100.0")), F.col("capacity"))
    return full.select(
        "item_id",
        "item_name",
        "item_type",
        "capacity",
        "occupied",
        (F.col("capacity") - F.col("occupied")).alias("available"),
        F.round(percent, 1).cast("double").alias("occupancy_pct"),
        "cancelled",
    )


def occupancy_by_type(report: DataFrame) -> DataFrame:
    return report.groupBy("item_type").agg(
        F.sum("capacity").alias("total_capacity"),
        F.sum("occupied").alias("occupied"),
        (F.sum("capacity") - F.sum("occupied")).alias("available"),
    )


def overbooked(report: DataFrame) -> DataFrame:
    return report.filter("occupied > capacity").select("item_id", "item_name", "capacity", "occupied")
