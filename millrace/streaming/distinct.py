"""Distinct counts on streams by sketches that merge.

An exact distinct count would have to keep every value as state, and streams
refuse it. A HyperLogLog sketch per window is a few kilobytes of state at any
number of values, is updated by every micro-batch, and sketches of windows or
keys merge into those of longer windows or fewer keys without the events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.functions import rules
from millrace.streaming.windows import windowed

SKETCH = "sketch"
LOG_BUCKETS = 12


def relative_error(log_buckets: int = LOG_BUCKETS, deviations: float = 3) -> float:
    """Bound of the relative error of an estimate, by standard deviations; a merged sketch keeps it."""
    return deviations * 1.04 / 2 ** (log_buckets / 2)


def sketches(
    stream: DataFrame,
    column: str,
    keys: Sequence[str] = (),
    size: str = rules.WINDOW_SIZE,
    slide: str | None = None,
    log_buckets: int = LOG_BUCKETS,
) -> DataFrame:
    """A sketch of the values of ``column`` per window and key. Nulls do not count."""
    return windowed(stream, [F.hll_sketch_agg(column, F.lit(log_buckets)).alias(SKETCH)], keys, size, slide)


def estimates(found: DataFrame, keys: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """Estimated number of different values per key, from all sketches of the key."""
    return found.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias(name))
