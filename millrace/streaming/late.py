"""Late rows that are accounted for.

A watermark drops what comes too late and tells only how many partial results
that were. Here every micro-batch is split before it is counted: the mark is the
latest event time of all earlier batches less the allowed delay, and a row is
late when its window ended by then. Late rows go to a side table with the batch
and the mark that judged them; the others are counted per window. What arrived is
what was counted and what was late, row by row.

A retried batch is judged by the same mark, since it depends on earlier batches
only, and overwrites its own folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions import rules
from millrace.operators.layout import reused
from millrace.streaming.panes import seconds
from millrace.streaming.tables import BATCH, per_batch

_MARK = "mark timestamp"


def _mark(spark: SparkSession, out: str, batch_id: int):
    """The latest event time of the batches before this one, or None; one row a batch is read."""
    if batch_id == 0:
        return None
    marks = spark.read.schema(f"{_MARK}, {BATCH} long").parquet(f"{out}/marks")
    return marks.filter(F.col(BATCH) < batch_id).agg(F.max("mark")).first()[0]


def split(
    stream: DataFrame, out: str, size: str = rules.WINDOW_SIZE, delay: str = rules.WATERMARK, time: str = "event_time"
) -> DataStreamWriter:
    """Write each batch's counts per window, its late rows and its latest time. Rows without a time are late."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = _mark(spark, out, batch_id)
        mark = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {seconds(delay)} SECONDS")
        # Not F.window, which leaves rows without a time out.
        length = seconds(size) * 1_000_000
        start = F.timestamp_micros(F.unix_micros(time) - F.pmod(F.unix_micros(time), F.lit(length).cast("long")))
        with reused(batch.withColumn("window_start", start)) as rows:
            ended = F.col("window_start") + F.expr(f"INTERVAL {seconds(size)} SECONDS") <= mark
            is_late = F.coalesce(ended, F.lit(False)) | F.col("window_start").isNull()
            judged = rows.withColumn("judged_by", mark)
            judged.filter(is_late).write.mode("overwrite").parquet(f"{out}/late/{BATCH}={batch_id}")
            counts = rows.filter(~is_late).groupBy("window_start").agg(F.count("*").alias("n"))
            counts.write.mode("overwrite").parquet(f"{out}/counts/{BATCH}={batch_id}")
            rows.agg(F.max(time).alias("mark")).write.mode("overwrite").parquet(f"{out}/marks/{BATCH}={batch_id}")

    return per_batch(stream, f"{out}/checkpoint", handle)


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """Every row that came too late, with its batch and the mark that judged it."""
    return spark.read.parquet(f"{out}/late")


def reconciled(spark: SparkSession, out: str, size: str = rules.WINDOW_SIZE) -> DataFrame:
    """(window_start, on_time, late): all rows that arrived, by window."""
    counted = spark.read.parquet(f"{out}/counts").groupBy("window_start").agg(F.sum("n").alias("on_time"))
    late = late_rows(spark, out).groupBy("window_start").agg(F.count("*").alias("late"))
    both = counted.withColumnRenamed("window_start", "w").join(late, F.col("w").eqNullSafe(F.col("window_start")), "full")
    start = F.coalesce("w", "window_start").alias("window_start")
    return both.select(start, F.coalesce("on_time", F.lit(0)).alias("on_time"), F.coalesce("late", F.lit(0)).alias("late"))
