"""Spike alerts inside the stream, one micro-batch after the other.

Counts of sliding windows are a first aggregate. A second one, over windows of
two slides on the ends of the first, brings each window together with the one
that began a slide earlier: no join, no second read of the events and no table
that must be drained first. Both run in append mode, so an alert comes once,
when the watermark says that its counts are final.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.functions import rules
from millrace.streaming.panes import seconds


def spike_alerts(
    stream: DataFrame,
    keys: Sequence[str] = (),
    size: str = rules.WINDOW_SIZE,
    slide: str = rules.WINDOW_SLIDE,
    min_count: int = rules.SPIKE_MIN_COUNT,
    growth: float = rules.SPIKE_GROWTH,
) -> DataFrame:
    """Windows whose count jumped against the window one slide earlier, per key.

    ``stream`` carries ``event_time`` with a watermark. A window without events
    counts as zero. Rows: window_start, window_end, the keys, n and previous.
    """
    step, length = seconds(slide), seconds(size)
    counts = stream.groupBy(F.window("event_time", size, slide), *keys).agg(F.count("*").alias("n"))
    # The last microsecond of each window, which still carries the watermark.
    ends = counts.withColumn("at", F.window_time("window")).drop("window")
    pair = F.window("at", f"{2 * step} seconds", f"{step} seconds", f"{length % step} seconds")
    count = F.struct("at", "n")
    met = ends.groupBy(pair.alias("pair"), *keys).agg(F.min(count).alias("first"), F.max(count).alias("last"))
    end = F.col("pair.end")
    micro = F.expr("INTERVAL 1 MICROSECOND")
    is_now = F.col("last.at") == end - micro
    is_before = F.col("first.at") == end - F.expr(f"INTERVAL {step} SECONDS") - micro
    compared = met.filter(is_now).select(
        (end - F.expr(f"INTERVAL {length} SECONDS")).alias("window_start"),
        end.alias("window_end"),
        *keys,
        F.col("last.n").alias("n"),
        F.when(is_before, F.col("first.n")).otherwise(0).alias("previous"),
    )
    jumped = (F.col("previous") == 0) | (F.col("n") >= growth * F.col("previous"))
    return compared.filter((F.col("n") >= min_count) & jumped)
