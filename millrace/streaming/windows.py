"""Event-time windows over streams.

Size, slide and watermark are parameters. Results depend on when an event
happened, not on when its file arrived. ``event_time`` must be a timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import rules
from millrace.functions.money import total


def timed(stream: DataFrame, column: str, watermark: str | None = rules.WATERMARK) -> DataFrame:
    """Add ``event_time`` from a text, date or timestamp column."""
    value = F.col(column)
    kind = dict(stream.dtypes)[column]
    parsed = F.try_to_timestamp(value) if kind == "string" else value.cast("timestamp")
    stream = stream.withColumn("event_time", parsed)
    return stream.withWatermark("event_time", watermark) if watermark else stream


def windowed(
    stream: DataFrame,
    measures: Sequence[Column],
    keys: Sequence[str] = (),
    size: str = rules.WINDOW_SIZE,
    slide: str | None = None,
) -> DataFrame:
    """Aggregate per window and key; tumbling without a slide.

    Spark combines rows of a key within each task before the shuffle and
    keeps one state row per window and key.
    """
    grouped = stream.groupBy(F.window("event_time", size, slide), *keys).agg(*measures)
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *(c for c in grouped.columns if c != "window"),
    )


def sliding_counts(stream: DataFrame, size: str = rules.WINDOW_SIZE, slide: str = rules.WINDOW_SLIDE) -> DataFrame:
    return windowed(stream, [F.count("*").alias("n")], size=size, slide=slide)


def sliding_sums(
    stream: DataFrame,
    key: str | None,
    amount: str = "amount",
    size: str = rules.WINDOW_SIZE,
    slide: str = rules.WINDOW_SLIDE,
) -> DataFrame:
    """Rolling total per key, or over everything when the key is None."""
    keys = [key] if key else []
    return windowed(stream, [total(amount).alias("total")], keys, size, slide)


def spikes(
    counts: DataFrame,
    slide: str = rules.WINDOW_SLIDE,
    min_count: int = rules.SPIKE_MIN_COUNT,
    growth: float = rules.SPIKE_GROWTH,
) -> DataFrame:
    """Windows whose count jumped against the window one slide earlier.

    ``counts`` is the finished table of sliding counts. A window without
    events has no row there and counts as zero: the earlier window is looked
    up by its start, so no grid of windows has to be filled in.
    """
    earlier = counts.select(
        (F.col("window_start") + F.expr(f"INTERVAL {slide}")).alias("window_start"),
        F.col("n").alias("previous"),
    )
    compared = counts.join(earlier, "window_start", "left").na.fill({"previous": 0})
    jumped = (F.col("previous") == 0) | (F.col("n") >= growth * F.col("previous"))
    return compared.filter((F.col("n") >= min_count) & jumped)
