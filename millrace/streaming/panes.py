"""Sliding windows from panes: every row is counted once, in the pane of one slide that it falls into.

A sliding window as such copies each row into size / slide windows before
anything is combined, and keeps as many states. Here the stream keeps one state
a key and pane, and writes panes as they change; a window is put together from
its panes, of which there are few, when results are read. Sums are carried as
exact parts, so a window's sum is rounded once, however many panes it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import exact, rules
from millrace.streaming.windows import windowed

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
COUNT, SUM = "__n", "__sum"


def seconds(length: str) -> int:
    """'10 minutes' as a number of seconds."""
    number, unit = length.split()
    return int(number) * _SECONDS[unit.lower().removesuffix("s")]


def panes(stream: DataFrame, keys: Sequence[str] = (), amount: str | None = None, slide: str = rules.WINDOW_SLIDE) -> DataFrame:
    """Rows, and parts of the sum of ``amount``, per key and pane."""
    measures = [F.count("*").alias(COUNT)]
    if amount:
        measures += exact.parts(F.col(amount)).named(SUM)
    return windowed(stream, measures, keys, slide).drop("window_end").withColumnRenamed("window_start", "pane")


def over_panes(
    found: DataFrame,
    keys: Sequence[str] = (),
    size: str = rules.WINDOW_SIZE,
    slide: str = rules.WINDOW_SLIDE,
    count: str | None = "n",
    total: str | None = None,
) -> DataFrame:
    """Windows of ``size`` at every ``slide`` that hold a pane, with the measures that are named."""
    if seconds(size) % seconds(slide):
        raise ValueError(f"{size} is no multiple of {slide}")
    step, whole = F.expr(f"INTERVAL {seconds(slide)} SECONDS"), F.expr(f"INTERVAL {seconds(size)} SECONDS")
    starts = F.sequence(F.col("pane") - whole + step, F.col("pane"), step)
    measures: list[Column] = []
    if count:
        measures.append(F.sum(COUNT).alias(count))
    if total:
        measures.append(exact.merged(SUM).rounded().alias(total))
    spread = found.withColumn("window_start", F.explode(starts))
    grouped = spread.groupBy("window_start", *keys).agg(*measures)
    return grouped.withColumn("window_end", F.col("window_start") + whole)
