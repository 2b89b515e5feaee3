"""Parsing, rejecting, counting: data quality for dirty feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from millrace.functions.text import strip

BLANKS = r"\s+"


@dataclass(frozen=True)
class LineSpec:
    """Layout of a delimited line.

    ``fields`` lists (name, type) in order, ``required`` the names that must
    not be empty, ``positive`` the numbers that must be above zero, ``upper``
    and ``lower`` the texts to fold, ``allowed`` closed value lists.
    """

    fields: Sequence[tuple[str, str]]
    delimiter: str = ","
    required: Sequence[str] = ()
    positive: Sequence[str] = ()
    upper: Sequence[str] = ()
    lower: Sequence[str] = ()
    allowed: Mapping[str, Sequence[str]] | None = None


def parse_delimited(df: DataFrame, spec: LineSpec, line: str = "value") -> DataFrame:
    """Split lines into typed columns plus ``is_valid``; other columns stay.

    A bad row is flagged, never dropped or failed on. NaN and infinities
    count as bad numbers: Spark orders them above every value, and no sum survives them.
    """
    typed: list[Column] = [(F.size("__parts") == len(spec.fields)).alias("__complete")]
    checks: list[Column] = [F.col("__complete")]
    for i, (name, kind) in enumerate(spec.fields):
        value = F.try_element_at(F.col("__parts"), F.lit(i + 1))
        if kind == "string":
            value = strip(value)
        else:  # casts ignore white space around a number
            value = value.try_cast(kind)
            checks.append(F.col(name).isNotNull())
            if kind == "double":
                checks.append(~F.isnan(name) & (F.abs(F.col(name)) < F.lit(float("inf"))))
        if name in spec.upper:
            value = F.upper(value)
        if name in spec.lower:
            value = F.lower(value)
        typed.append(value.alias(name))
        if name in spec.required:
            checks.append(F.col(name) != "")
        if name in spec.positive:
            checks.append(F.col(name) > 0)
        if spec.allowed and name in spec.allowed:
            checks.append(F.col(name).isin(*spec.allowed[name]))
    valid = checks[0]
    for check in checks[1:]:
        valid = valid & check

    carried = [c for c in df.columns if c != line]
    # Blanks as delimiter would make an empty field of blanks at either end.
    text = strip(F.col(line)) if spec.delimiter == BLANKS else F.col(line)
    split = df.withColumn("__parts", F.split(text, spec.delimiter, -1))
    # The generator keeps later filters above the parse. Without it Spark pushes
    # each condition down as a copy of the whole split expression.
    fields = split.select(*carried, F.inline(F.array(F.struct(*typed))))
    return fields.withColumn("is_valid", F.coalesce(valid, F.lit(False))).drop("__complete")


def valid_only(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_valid").drop("is_valid")


def reject_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule a row breaks; NULL for a good row.

    A rule that evaluates to NULL does not reject.
    """
    (name, broken), *rest = rules
    chain = F.when(broken, F.lit(name))
    for name, broken in rest:
        chain = chain.when(broken, F.lit(name))
    return chain


def accepted(df: DataFrame, reason: str = "reject_reason") -> DataFrame:
    return df.filter(F.col(reason).isNull()).drop(reason)


def rejected(df: DataFrame, reason: str = "reject_reason") -> DataFrame:
    return df.filter(F.col(reason).isNotNull())


def quarantine_counts(df: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """Rows per outcome; accepted rows count as ``valid``."""
    outcome = F.coalesce(F.col(reason), F.lit("valid")).alias("outcome")
    return df.groupBy(outcome).agg(F.count("*").alias("n"))


def out_of_range(ranges: Sequence[tuple[str, float, float, str]]) -> Column:
    """List of ``Label=value`` texts for columns outside their range."""
    reasons = []
    for name, low, high, label in ranges:
        value = F.col(name)
        broken = (value < low) | (value > high)
        reasons.append(F.when(broken, F.concat(F.lit(f"{label}="), value.cast("string"))))
    return F.array_compact(F.array(*reasons))


def counted(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """Attach row counters that fill in while the data flows by.

    Read ``observation.get`` after an action that reads the frame once, such
    as a write. A global sort right above would count twice, because it samples
    its input in a pass of its own.
    """
    observation = Observation(name)
    return df.observe(observation, *(m.alias(k) for k, m in measures.items())), observation


def differing_rows(df: DataFrame, first: str, second: str) -> int:
    """Rows on which two implementations disagree (NULLs compare equal)."""
    return df.filter(~F.col(first).eqNullSafe(F.col(second))).count()


def same_contract(df: DataFrame, contract: T.StructType) -> bool:
    """Names and types equal the declared ones (nullability aside)."""
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in contract]
