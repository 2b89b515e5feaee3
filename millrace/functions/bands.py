"""Labels from limits: amount, salary, age, risk and tier bands."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F, types as T

from millrace.functions import rules


def band(value: Column, steps: Sequence[tuple[object, str]], default: str) -> Column:
    """First label whose lower limit the value reaches, else the default."""
    (limit, label), *rest = steps
    chain = F.when(value >= F.lit(limit), F.lit(label))
    for limit, label in rest:
        chain = chain.when(value >= F.lit(limit), F.lit(label))
    return chain.otherwise(F.lit(default))


def amount_band(value: Column) -> Column:
    return band(value, rules.AMOUNT_BANDS, rules.BAND_DEFAULT)


def salary_band(value: Column) -> Column:
    return band(value, rules.SALARY_BANDS, rules.BAND_DEFAULT)


def age_group(age: Column) -> Column:
    return F.when(age < rules.ADULT_AGE, "Young").otherwise("Adult")


def customer_tier(
    spend: Column,
    steps: Sequence[tuple[object, str]] = rules.TIER_BANDS,
    default: str = rules.TIER_DEFAULT,
) -> Column:
    return band(spend, steps, default)


def risk_category(total: Column, largest: Column, count: Column) -> Column:
    high = (total >= rules.RISK_HIGH_TOTAL) | (largest >= rules.RISK_HIGH_SINGLE)
    medium = (
        (total >= rules.RISK_MEDIUM_TOTAL)
        | (largest >= rules.RISK_MEDIUM_SINGLE)
        | (count >= rules.RISK_MEDIUM_COUNT)
    )
    return F.when(high, "HIGH").when(medium, "MEDIUM").otherwise("LOW")


def tax_rate(gross: Column) -> Column:
    chain = None
    for limit, fraction in rules.TAX_BANDS:
        step = F.lit(fraction).cast("decimal(6,4)")
        chain = F.when(gross > limit, step) if chain is None else chain.when(gross > limit, step)
    return chain.otherwise(F.lit(rules.TAX_DEFAULT).cast("decimal(6,4)"))


# --- vectorised twins -------------------------------------------------------
# The native expressions above are what jobs use. The twins exist for callers
# who need the band under a function name in SQL, and to check both agree.


def _label(values: pd.Series, steps: Sequence[tuple[object, str]], default: str) -> pd.Series:
    labels = pd.Series(default, index=values.index, dtype=object)
    for limit, label in reversed(steps):
        labels[values >= limit] = label
    return labels


@F.pandas_udf(T.StringType())
def salary_band_udf(salary: pd.Series) -> pd.Series:
    return _label(salary, rules.SALARY_BANDS, rules.BAND_DEFAULT)


@F.pandas_udf(T.StringType())
def risk_category_udf(total: pd.Series, largest: pd.Series, count: pd.Series) -> pd.Series:
    medium = (
        (total >= rules.RISK_MEDIUM_TOTAL)
        | (largest >= rules.RISK_MEDIUM_SINGLE)
        | (count >= rules.RISK_MEDIUM_COUNT)
    )
    high = (total >= rules.RISK_HIGH_TOTAL) | (largest >= rules.RISK_HIGH_SINGLE)
    labels = pd.Series("LOW", index=total.index, dtype=object)
    labels[medium] = "MEDIUM"
    labels[high] = "HIGH"
    return labels


def register_band_functions(spark: SparkSession) -> None:
    """Make the twins callable from SQL text."""
    spark.udf.register("salary_band", salary_band_udf)
    spark.udf.register("risk_category", risk_category_udf)
