"""Joins that hold when one key owns a large part of the rows.

Spark splits a hot join partition (adaptive skew join) only on a side whose
rows need no partner bookkeeping. Outer joins that keep the *small* side of a
hot key are therefore written as an inner join plus the keys without partner,
which are found against the distinct keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A broadcast copy lives on every executor and passes through the driver.
BROADCAST_BYTES = 10 << 20


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether Spark estimates the frame at no more than ``max_bytes``; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= max_bytes


def hinted_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast for a frame of checked size.

    Beyond it the frame is returned as it is, and Spark's own threshold and
    adaptive execution decide by the size they see.
    """
    return F.broadcast(df) if is_small(df, max_bytes) else df


def look_up(fact: DataFrame, lookup: DataFrame, on: str, how: str = "inner", salts: int = 1) -> DataFrame:
    """Join a stream or table with a lookup table on a shared key.

    Spark plans every micro-batch anew and broadcasts the lookup only while its
    size allows. Adaptive skew handling does not cover streams: for keys that
    own a large part of a batch, ``salts`` copies of the lookup spread them.
    ``how`` is one of inner, left, left_semi and left_anti.
    """
    if salts == 1:
        return fact.join(lookup, on, how)
    # The hash of the whole row is the same again when a task is retried.
    salt = F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int")
    copies = lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return fact.withColumn("__salt", salt).join(copies, [on, "__salt"], how).drop("__salt")


def _pairs(on: str | Sequence[str] | Mapping[str, str]) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(name, name) for name in on]


def _condition(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    condition = None
    for a, b in pairs:
        step = left[a] == right[b]
        condition = step if condition is None else condition & step
    return condition


def _merged(joined: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Drop the right copy of keys that share a name with the left."""
    for a, b in pairs:
        if a == b:
            joined = joined.drop(right[b])
    return joined


def match(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Inner equi-join; ``on`` is a shared name, names, or {left: right}."""
    pairs = _pairs(on)
    return _merged(left.join(right, _condition(left, right, pairs), "inner"), right, pairs)


def enrich(
    fact: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Keep every fact row and add lookup columns, with defaults for misses.

    The fact side is the one Spark may split, so hot fact keys are fine.
    """
    pairs = _pairs(on)
    joined = _merged(fact.join(lookup, _condition(fact, lookup, pairs), "left"), lookup, pairs)
    filled = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in (defaults or {}).items()}
    return joined.withColumns(filled) if filled else joined


def _distinct_keys(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names).distinct()


def without_partner(
    left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str]
) -> DataFrame:
    """Left rows whose key does not occur on the right."""
    pairs = _pairs(on)
    keys = _distinct_keys(right, [b for _, b in pairs])
    return left.join(keys, _condition(left, keys, pairs), "left_anti")


def with_partner(
    left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str]
) -> DataFrame:
    """Left rows whose key occurs on the right, each once."""
    pairs = _pairs(on)
    keys = _distinct_keys(right, [b for _, b in pairs])
    return left.join(keys, _condition(left, keys, pairs), "left_semi")


def keep_all(
    kept: DataFrame, fact: DataFrame, on: str | Sequence[str] | Mapping[str, str]
) -> DataFrame:
    """Left outer join that keeps ``kept`` while ``fact`` may have hot keys."""
    pairs = _pairs(on)
    lonely = without_partner(kept, fact, on)
    return match(kept, fact, on).unionByName(lonely, allowMissingColumns=True)


def keep_both(
    left: DataFrame, right: DataFrame, on: Mapping[str, str]
) -> DataFrame:
    """Full outer join of tables whose key names differ, hot keys on the left."""
    both = left.join(right, _condition(left, right, _pairs(on)), "left")
    lonely = without_partner(right, left, {b: a for a, b in on.items()})
    return both.unionByName(lonely, allowMissingColumns=True)
