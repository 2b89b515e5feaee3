"""Patient monitor: readings out of range, running counts, repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions import rules
from millrace.operators.quality import LineSpec, out_of_range, parse_delimited, valid_only
from millrace.streaming.tables import batch_report
from millrace.streaming.windows import windowed

VITAL_LINE = LineSpec(
    fields=(
        ("patient_id", "string"),
        ("heart_rate", "int"),
        ("spo2", "int"),
        ("systolic_bp", "int"),
        ("temperature", "double"),
    ),
    required=("patient_id",),
)


def readings(lines: DataFrame) -> DataFrame:
    """Parsed lines including the bad ones (``is_valid``), for counting."""
    return parse_delimited(lines, VITAL_LINE)


def counted_readings(lines: DataFrame, name: str = "vitals") -> DataFrame:
    """Readings with counters of all, invalid and abnormal ones.

    On a stream every micro-batch reports them in its progress, under ``name``.
    """
    parsed = readings(lines)
    abnormal = F.col("is_valid") & (F.size(out_of_range(rules.VITAL_RANGES)) > 0)
    return parsed.observe(
        name,
        F.count("*").alias("total"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
        F.count_if(abnormal).alias("abnormal"),
    )


def monitor(lines: DataFrame, out: str) -> DataStreamWriter:
    """Alerts of every micro-batch below ``out``, with counters in the progress."""
    return batch_report(counted_readings(lines), out, lambda batch: alerts(valid_only(batch)))


def alerts(valid: DataFrame) -> DataFrame:
    """Readings with at least one vital out of range, and which."""
    judged = valid.withColumn("found", out_of_range(rules.VITAL_RANGES))
    return judged.filter(F.size("found") > 0).withColumn("reasons", F.array_join("found", ", ")).drop("found")


def running_abnormal(abnormal: DataFrame) -> DataFrame:
    return abnormal.groupBy("patient_id").agg(F.count("*").alias("total_abnormal"))


def repeated(
    abnormal: DataFrame,
    limit: int = rules.REPEAT_LIMIT,
    size: str = rules.WINDOW_SIZE,
    slide: str = rules.WINDOW_SLIDE,
) -> DataFrame:
    """Patients with at least ``limit`` abnormal readings in a window."""
    counts = windowed(abnormal, [F.count("*").alias("n")], ["patient_id"], size, slide)
    return counts.filter(F.col("n") >= limit)
