"""Sums of amounts, independent of the order of addition, which no cluster fixes.

``total`` and ``mean`` take any doubles: their sum is exact and rounded once
(``functions/exact.py``). A decimal column needs neither: ``total_of`` sums it
as it is.

Where a result must be exact in decimals (products of prices and discounts,
amounts carried from batch to batch), amounts are whole units of a declared
number of decimals. Long arithmetic stays in generated code and is about ten
times faster than decimals; each unit count is summed in two parts, so no sum
can overflow below some trillions of rows. Declared decimals are a contract: an
amount that has more, or that is not finite, fails the query and is named.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.exact import exact_sum

_LOW_BITS = 20
# Decimals of an amount unless a call names another number.
DECIMALS = 6


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value.cast("double")) < F.lit(float("inf")))


def units(value: Column | str, scale: int = DECIMALS) -> Column:
    """An amount as a whole number of its smallest unit."""
    exact = _col(value).cast("double") * F.lit(float(10**scale))
    whole = F.rint(exact)
    # A double carries some 16 digits: what is left of the last ones is not a decimal.
    sound = F.abs(exact - whole) <= F.lit(1e-3) + F.abs(exact) * F.lit(2.0**-50)
    message = F.concat(F.lit(f"amount is not finite or has more than {scale} decimals: "), _col(value).cast("string"))
    return F.when(exact.isNull(), F.lit(None)).when(sound, whole.cast("long")).otherwise(F.raise_error(message).cast("long"))


def total_units(unit_count: Column, scale: int) -> Column:
    """Exact sum of whole units, as a decimal amount."""
    high = F.sum(F.shiftright(unit_count, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(unit_count.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("long"))).cast("decimal(20,0)")
    return (high * F.lit(Decimal(1 << _LOW_BITS)) + low) * F.lit(Decimal(1).scaleb(-scale))


def exact_total(value: Column | str, scale: int = DECIMALS) -> Column:
    """Exact sum of an amount, as a decimal."""
    return total_units(units(value, scale), scale)


def total(value: Column | str) -> Column:
    """Sum of any doubles, exact and rounded once; NaN or infinite if a plain sum is."""
    return exact_sum(value)


def mean(value: Column | str) -> Column:
    """Exact sum divided once by the number of non-null values; NULL if there is none."""
    return F.try_divide(total(value), F.count(_col(value)).cast("double"))


def total_of(df: DataFrame, name: str) -> Column:
    """Sum of a column by its type: decimals and whole numbers as they are, doubles exactly."""
    kind = df.schema[name].dataType
    return total(name) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.sum(name)


def line_amount(quantity: Column | str, price: Column | str, scale: int = DECIMALS) -> Column:
    """Quantity times price, exact to the last decimal of the price."""
    return units(price, scale) * _col(quantity) / F.lit(float(10**scale))


def discounted_total(amount: Column | str, discount: Column | str, scale: int = 2, discount_scale: int = 4) -> Column:
    """Sum of ``amount * (1 - discount)``, for amounts and discounts of so many decimals."""
    kept = F.lit(10**discount_scale).cast("long") - units(discount, discount_scale)
    return total_units(units(amount, scale) * kept, scale + discount_scale).cast("double")


def _decimal(value: Column | str, digits: int, scale: int) -> Column:
    return (units(value, scale).cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal({digits},{scale})")


def money(value: Column | str, scale: int = DECIMALS) -> Column:
    """A single amount as a decimal, for windows and row-level output."""
    return _decimal(value, 24, scale)


def price(value: Column | str, scale: int = 2) -> Column:
    """A single price; narrow enough that products of it stay exact."""
    return _decimal(value, 12, scale)


def rate(value: Column | str, scale: int = 4) -> Column:
    """A fraction such as a discount or a tax rate."""
    return _decimal(value, 6, scale)
