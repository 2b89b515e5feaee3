"""Each micro-batch against everything so far, with the running totals in the state store.

Two queries in a row. The first brings every micro-batch down to one row per
key, its count and the parts of its exact sum, under the number of the batch.
The second adds these rows up: a batch touches the totals of its own keys and
writes those, and the rows of one key that it reads are as many as batches.
The report is put together on reading, where keys without a row in the last
batch stand with 0.

A batch that is retried after its sums were finished passes them over, since
the same rows have the same exact sums; one that was not finished is written
again. The second query must not run while the first one does: ``steps`` gives
the order, and ``advance`` keeps it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions import exact
from millrace.streaming.tables import BATCH, changes_table, drain, finished_batches, per_batch, read_latest

_AMOUNT = "amount_"


def batch_sums(entries: DataFrame, out: str, key: str = "account", amount: str = "amount") -> DataStreamWriter:
    """Write (key, n, parts of the sum) of every micro-batch; null keys are a key, null amounts count but add nothing."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch_id in finished_batches(batch.sparkSession, f"{out}/sums"):
            return
        sums = batch.groupBy(F.col(key).cast("string").alias("key")).agg(
            F.count("*").alias("n"), *exact.parts(F.col(amount)).named(_AMOUNT)
        )
        sums.write.mode("overwrite").parquet(f"{out}/sums/data/{BATCH}={batch_id}")

    return per_batch(entries, f"{out}/sums/checkpoint", handle)


def _sums_schema(spark: SparkSession) -> T.StructType:
    nothing = spark.createDataFrame([], "key string, amount double")
    sums = nothing.groupBy("key").agg(F.count("*").alias("n"), *exact.parts(F.col("amount")).named(_AMOUNT))
    return T.StructType([*sums.schema.fields, T.StructField(BATCH, T.LongType())])


def running(spark: SparkSession, out: str, files_per_batch: int | None = None) -> DataFrame:
    """(key, upto, batch_n, total_n, total_amount) of keys as they change; ``upto`` is the last batch that names the key."""
    reader = spark.readStream.schema(_sums_schema(spark))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{out}/sums/data").groupBy("key").agg(
        F.max(BATCH).alias("upto"),
        F.max_by("n", BATCH).alias("batch_n"),
        F.sum("n").alias("total_n"),
        exact.merged(_AMOUNT).rounded().alias("total_amount"),
    )


def steps(spark: SparkSession, entries: DataFrame, out: str, key: str = "account", amount: str = "amount") -> list[Callable[[], DataStreamWriter]]:
    """The two queries in order; the second needs what the first has finished."""
    return [lambda: batch_sums(entries, out, key, amount), lambda: changes_table(running(spark, out), f"{out}/totals")]


def advance(spark: SparkSession, entries: DataFrame, out: str, key: str = "account", amount: str = "amount") -> None:
    """Take in everything that has arrived."""
    for step in steps(spark, entries, out, key, amount):
        drain(step(), closing_batch=False)


def compared(spark: SparkSession, out: str, key: str = "account") -> DataFrame:
    """(batch_id, key, batch_n, total_n, total_amount) after the last batch; keys that it does not name stand with 0."""
    batches = finished_batches(spark, f"{out}/sums")
    last = F.lit(batches[-1] if batches else None).cast("long")
    now = read_latest(spark, f"{out}/totals", running(spark, out).schema, ["key"])
    return now.select(
        last.alias(BATCH),
        F.col("key").alias(key),
        F.when(F.col("upto") == last, F.col("batch_n")).otherwise(F.lit(0).cast("long")).alias("batch_n"),
        "total_n",
        "total_amount",
    )
