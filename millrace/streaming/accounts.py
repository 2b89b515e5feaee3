"""Account monitors: batch totals, running totals, enrichment, bursts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions import rules
from millrace.functions.money import exact_total, total
from millrace.operators import joins
from millrace.operators.quality import BLANKS, LineSpec, parse_delimited, valid_only
from millrace.streaming import panes
from millrace.streaming.tables import carried_state

# ACCOUNT TYPE AMOUNT
ACCOUNT_LINE = LineSpec(
    fields=(("account", "string"), ("kind", "string"), ("amount", "double")),
    delimiter=BLANKS,
    positive=("amount",),
    upper=("kind",),
)
# TXN_ID STORE AMOUNT
STORE_LINE = LineSpec(
    fields=(("txn_id", "string"), ("store", "string"), ("amount", "double")),
    delimiter=BLANKS,
    positive=("amount",),
)
# txn, account, branch, type, amount
BANK_LINE = LineSpec(
    fields=(
        ("txn_id", "string"),
        ("account", "string"),
        ("branch_id", "string"),
        ("kind", "string"),
        ("amount", "double"),
    ),
    required=("txn_id", "account"),
    positive=("amount",),
    upper=("kind",),
)


def parse(lines: DataFrame, spec: LineSpec) -> DataFrame:
    return valid_only(parse_delimited(lines, spec))


def totals(entries: DataFrame, key: str = "account") -> DataFrame:
    """Count and amount per key: of a batch, or running when on a stream."""
    return entries.groupBy(key).agg(F.count("*").alias("n"), total("amount").alias("amount"))


COMPARISON = T.StructType(
    [
        T.StructField("account", T.StringType()),
        T.StructField("batch_n", T.LongType()),
        T.StructField("total_n", T.LongType()),
        T.StructField("total_amount", T.DecimalType(34, 6)),
    ]
)


def compare_step(before: DataFrame | None, batch: DataFrame) -> DataFrame:
    """This batch against everything so far; known accounts stay, with 0."""
    now = batch.groupBy("account").agg(
        F.count("*").alias("batch_n"), exact_total("amount").cast("decimal(34,6)").alias("batch_amount")
    )
    if before is None:
        return now.select("account", "batch_n", F.col("batch_n").alias("total_n"), F.col("batch_amount").alias("total_amount"))
    known = before.select("account", "total_n", "total_amount")
    joined = known.join(now, "account", "full")

    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return joined.select(
        "account",
        number("batch_n").alias("batch_n"),
        (number("total_n") + number("batch_n")).alias("total_n"),
        (number("total_amount") + number("batch_amount")).cast("decimal(34,6)").alias("total_amount"),
    )


def with_branch(entries: DataFrame, branches: DataFrame, big_amount: float = rules.BIG_AMOUNT) -> DataFrame:
    """Branch and risk per transaction, with a flag for the ones to look at.

    A transaction of an unknown branch is kept and flagged.
    """
    names = ("branch_name", "city", "risk_level")
    looked_up = joins.look_up(entries, branches.select("branch_id", *names), "branch_id", "left")
    known = looked_up.withColumns({name: F.coalesce(name, F.lit(rules.UNKNOWN)) for name in names})
    flag = (
        F.when(F.col("risk_level") == rules.UNKNOWN, "UNKNOWN BRANCH")
        .when((F.col("risk_level") == "HIGH") & (F.col("amount") >= big_amount), "BIG AMOUNT")
        .otherwise("")
    )
    return known.withColumn("flag", flag)


def monitor(lines: DataFrame, branches: DataFrame, out: str) -> DataStreamWriter:
    """Flagged transactions of every micro-batch, and each account's batch against everything so far."""

    def flag(_: DataFrame, batch: DataFrame, batch_id: int) -> None:
        flagged = with_branch(batch, branches).filter("flag <> ''")
        flagged.write.mode("overwrite").parquet(f"{out}/flagged/batch_id={batch_id}")

    return carried_state(parse(lines, BANK_LINE), out, COMPARISON, compare_step, each=flag)


def burst_panes(entries: DataFrame, key: str = "account", slide: str = rules.WINDOW_SLIDE) -> DataFrame:
    """What ``bursts`` needs of a stream with ``event_time``: one state per key and slide, however many windows share it."""
    return panes.panes(entries, [key], "amount", slide)


def bursts(
    found: DataFrame,
    key: str = "account",
    limit: int = rules.BURST_LIMIT,
    size: str = rules.WINDOW_SIZE,
    slide: str = rules.WINDOW_SLIDE,
) -> DataFrame:
    """Keys with at least ``limit`` transactions in a window, put together from their panes.

    A pane only goes into windows if so many transactions lie within reach of
    it on both sides; few do where bursts are rare.
    """
    reach = panes.seconds(size) - panes.seconds(slide)
    near = Window.partitionBy(key).orderBy(F.unix_seconds("pane")).rangeBetween(-reach, reach)
    some = found.withColumn("__near", F.sum(panes.COUNT).over(near)).filter(F.col("__near") >= limit)
    windows = panes.over_panes(some, [key], size, slide, total="amount").filter(F.col("n") >= limit)
    return windows.select("window_start", "window_end", key, "n", "amount")
