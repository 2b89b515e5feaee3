"""Log monitor: errors, levels and frequent words."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions import rules, text
from millrace.operators.layout import reused
from millrace.streaming.tables import per_batch
from millrace.streaming.windows import timed, windowed


def parse_log(lines: DataFrame, watermark: str | None = rules.WATERMARK) -> DataFrame:
    """Fields of ``DATE TIME LEVEL message`` lines with their event time."""
    stripped = lines.withColumn("value", text.strip(F.col("value"))).filter("value != ''")
    fields = stripped.select("value", *text.log_fields(F.col("value")))
    return timed(fields.withColumn("stamp", F.concat_ws(" ", "log_date", "log_time")), "stamp", watermark)


def error_counts(log: DataFrame, size: str = rules.TUMBLING_SIZE) -> DataFrame:
    """ERROR lines per interval; an interval with other lines only shows 0."""
    return windowed(log, [F.count_if(F.col("level") == "ERROR").alias("errors")], size=size)


def level_counts(log: DataFrame, size: str = rules.TUMBLING_SIZE) -> DataFrame:
    """Lines per interval and level; lines too short for a level are left out."""
    return windowed(log.filter("level IS NOT NULL"), [F.count("*").alias("n")], ["level"], size)


def batch_top_words(batch: DataFrame, column: str = "value", n: int = 3) -> DataFrame:
    """Most frequent words of one micro-batch."""
    return text.word_counts(batch, column).orderBy(F.desc("n"), F.asc("word")).limit(n)


def batch_level_counts(batch: DataFrame) -> DataFrame:
    """Lines per level of one micro-batch."""
    return batch.filter("level IS NOT NULL").groupBy("level").agg(F.count("*").alias("n"))


def monitor(log: DataFrame, out: str) -> DataStreamWriter:
    """Lines per level, errors and frequent words of every micro-batch, each in a folder below ``out``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with reused(batch) as lines:
            parts = {"levels": batch_level_counts, "errors": batch_error_count, "words": batch_top_words}
            for name, report in parts.items():
                report(lines).write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")

    return per_batch(log, f"{out}/checkpoint", handle)


def batch_error_count(batch: DataFrame) -> DataFrame:
    """ERROR lines of one micro-batch, one row even when there are none."""
    return batch.agg(F.count_if(F.col("level") == "ERROR").alias("errors"))
