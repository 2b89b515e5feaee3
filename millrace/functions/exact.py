"""Sums of doubles that depend on no order: exact, and rounded once.

Every double is cut into signed pieces of ``WIDTH`` bits at fixed places of the
binary number line, and each place is summed as a long. These sums merge like
any others, so they survive partial aggregation, retries and any order of
rows; the last step adds them up with carries and rounds to the nearest double,
ties to even, as ``math.fsum`` does.

The places reach from 2^-134 to 2^64: every double from 2e-25 to 1.8e19 in
size, and every larger or smaller one whose bits lie within, is summed exactly.
What lies outside is added as a plain sum of doubles, as are NaN and the
infinities, with the outcome that these have anywhere. A place holds the sum of
10^12 rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

WIDTH = 22
PLACES = 9
LOWEST = -134
HIGHEST = LOWEST + WIDTH * PLACES


def _power(exponent: int) -> Column:
    return F.lit(2.0**exponent)


def _long(number: int) -> Column:
    return F.lit(number).cast("long")


@dataclass(frozen=True)
class Parts:
    """The sums of a measure by place, what lies outside, and whether there was a value at all."""

    places: tuple[Column, ...]
    outside: Column
    values: Column

    def named(self, prefix: str) -> list[Column]:
        columns = [*self.places, self.outside, self.values]
        return [c.alias(f"{prefix}{n}") for n, c in enumerate(columns)]

    def rounded(self) -> Column:
        """The sum as the nearest double; NULL without a value."""
        inside = _rounded(F.array(*self.places))
        return F.when(self.values > 0, F.coalesce(self.outside + inside, inside))


def parts(value: Column) -> Parts:
    """Sums of a double by place, as aggregates."""
    number = value.cast("double")
    bottom = number * _power(-LOWEST)
    inside = (F.abs(number) < _power(HIGHEST)) & (F.rint(bottom) == bottom)
    # Outside values have no pieces: zero is cut instead.
    held = F.when(inside, number).otherwise(F.lit(0.0))

    def above(place: int) -> Column:
        return F.rint(held * _power(-LOWEST - WIDTH * place))

    pieces = [above(n) - above(n + 1) * _power(WIDTH) for n in range(PLACES - 1)] + [above(PLACES - 1)]
    outside = F.sum(F.when(~inside, number))
    return Parts(tuple(F.sum(p.cast("long")) for p in pieces), outside, F.count(number))


def merged(prefix: str) -> Parts:
    """Sums of parts that were aggregated before under ``named(prefix)``."""
    names = [f"{prefix}{n}" for n in range(PLACES + 2)]
    return Parts(tuple(F.sum(n) for n in names[:PLACES]), F.sum(names[PLACES]), F.sum(names[PLACES + 1]))


def held(prefix: str) -> Parts:
    """Parts that stand in columns."""
    names = [F.col(f"{prefix}{n}") for n in range(PLACES + 2)]
    return Parts(tuple(names[:PLACES]), names[PLACES], names[PLACES + 1])


def exact_sum(value: Column | str) -> Column:
    """The exact sum of a double, rounded once; NULL if there is no value."""
    return parts(F.col(value) if isinstance(value, str) else value).rounded()


def _let(value: Column, then) -> Column:
    """Use a value several times, computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _digits(sums: Column) -> Column:
    """Digits of WIDTH bits, lowest first, with the sign as a last element of 0 or -1."""
    start = F.struct(_long(0).alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def step(state: Column, item: Column) -> Column:
        now = item + state["carry"]
        return F.struct(F.shiftright(now, WIDTH).alias("carry"), F.array_append(state["digits"], F.pmod(now, _long(1 << WIDTH))).alias("digits"))

    # Two places more than there are pieces, which take the carries of any number of rows.
    longer = F.concat(sums, F.array(_long(0), _long(0)))
    return F.aggregate(longer, start, step, lambda state: F.array_append(state["digits"], state["carry"]))


def _rounded(sums: Column) -> Column:
    def signed(digits: Column) -> Column:
        negative = F.element_at(digits, -1) < 0
        size = F.when(negative, _digits(F.transform(sums, lambda x: -x))).otherwise(digits)
        sign = F.when(negative, F.lit(-1.0)).otherwise(F.lit(1.0))
        return _let(F.concat(F.array(*[_long(0)] * 4), size), lambda whole: _nearest(whole) * sign)

    return _let(_digits(sums), signed)


def _nearest(digits: Column) -> Column:
    """The double nearest to digits whose four lowest are zero."""

    def at(first: Column) -> Column:
        def digit(below: int) -> Column:
            return F.element_at(digits, (first + 1 - below).cast("int")).cast("double")

        # Four digits hold 67 bits at least; whether anything stands below them is one bit more.
        below = F.exists(F.slice(digits, F.lit(1), (first - 3).cast("int")), lambda d: d != 0).cast("double")
        high, low = digit(0) * _power(WIDTH) + digit(1), digit(2) * _power(WIDTH) + digit(3)
        number = high * _power(2 * WIDTH + 1) + (low * 2 + below)
        unit = F.element_at(F.array(*[_power(LOWEST + WIDTH * (n - 7) - 1) for n in range(PLACES + 6)]), (first + 1).cast("int"))
        return F.when(first < 4, F.lit(0.0)).otherwise(number * unit)

    place = F.transform(digits, lambda d, n: F.when(d != 0, n).otherwise(F.lit(-1)))
    return _let(F.array_max(place), at)
