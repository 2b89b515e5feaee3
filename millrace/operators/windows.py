"""Window functions that survive a hot key.

A plain ``Window.partitionBy(key)`` hands all rows of a key to one task. The
functions here cut each key's ordered rows into buckets, number or sum within
a bucket, and add what the earlier buckets of that key contribute:

* the rows are shuffled once, by key and bucket;
* per key and bucket one small summary row is aggregated from that shuffle, and
  only those summaries meet in one window per key: a key may have millions of
  buckets, not billions.

Ranks are computed over the distinct values of each key and joined back, so
rows that tie need not meet in one task.

The bucket must follow the order: a later row never falls in an earlier
bucket. For ranks, rows that tie on the order column must share it. The minute
of a time or ``floor(amount / 100)`` do, and where ties are settled by an id,
``struct(day, id div 1000000)``. A task holds one bucket of one key at most, so
the bucket has to be fine enough for the hottest key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

_BUCKET = "__bucket"


@dataclass(frozen=True)
class Track:
    """Rows of each key in order.

    ``order`` is the column that decides; ``tiebreak`` makes the order total
    for functions that need one. ``bucket`` is a SQL expression.
    """

    keys: Sequence[str]
    order: str
    bucket: str
    tiebreak: Sequence[str] = ()
    descending: bool = False

    def directed(self, name: str) -> Column:
        return F.col(name).desc() if self.descending else F.col(name).asc()

    def by_order(self) -> list[Column]:
        return [self.directed(self.order)]

    def total_order(self) -> list[Column]:
        """Order column in its direction, tiebreak always ascending."""
        return [self.directed(self.order), *(F.col(name).asc() for name in self.tiebreak)]


def _filler(kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    return F.lit(0).cast(kind)


class _Cut:
    """Rows with columns for key and bucket that are never NULL.

    Window and join can then name the same columns and share one shuffle; a
    null-safe join condition would move the rows a second time.
    """

    def __init__(self, df: DataFrame, track: Track):
        self.track = track
        self.rows = df.withColumn(_BUCKET, F.expr(track.bucket))
        self.keys = [c for i, name in enumerate(track.keys) for c in self._solid(f"__k{i}", name)]
        self.parts = [*self.keys, *self._solid("__b", _BUCKET)]
        # One shuffle for rows and summaries, so that what comes before it runs once.
        self.rows = self.rows.repartition(*self.parts)

    def _solid(self, alias: str, name: str) -> list[str]:
        field = self.rows.schema[name]
        if not field.nullable:
            self.rows = self.rows.withColumn(alias, F.col(name))
            return [alias]
        flag = f"{alias}_null"
        self.rows = self.rows.withColumns(
            {alias: F.coalesce(F.col(name), _filler(field.dataType)), flag: F.col(name).isNull()}
        )
        return [alias, flag]

    def within(self, order: list[Column]) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(*order)

    def across(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.track.directed(_BUCKET))

    def earlier(self) -> WindowSpec:
        return self.across().rowsBetween(Window.unboundedPreceding, -1)

    def with_summary(self, local: Column, summary: Column, carry: Column) -> DataFrame:
        """Rows with a value from their own bucket and one carried over.

        The window comes first: the join finds its rows partitioned and sorted.
        """
        per_bucket = self.rows.groupBy(*self.parts, _BUCKET).agg(summary)
        rows = self.rows.withColumn("__local", local)
        return rows.join(per_bucket.select(*self.parts, carry), self.parts)


def _offset(
    df: DataFrame, track: Track, name: str, local: Callable[[_Cut], Column], amount: Column
) -> DataFrame:
    cut = _Cut(df, track)
    carry = F.coalesce(F.sum("__amount").over(cut.earlier()), F.lit(0)).alias("__before")
    joined = cut.with_summary(local(cut), amount.alias("__amount"), carry)
    return joined.select(*df.columns, (F.col("__local") + F.col("__before")).alias(name))


def with_row_number(df: DataFrame, track: Track, name: str = "row_number") -> DataFrame:
    return _offset(
        df, track, name, lambda cut: F.row_number().over(cut.within(track.total_order())), F.count("*")
    )


def _values(df: DataFrame, track: Track) -> tuple[DataFrame, Track]:
    """Rows per value of the order column of each key, and the track of those values."""
    counts = df.groupBy(*track.keys, track.order).agg(F.count("*").alias("__n"))
    return counts, replace(track, tiebreak=())


def _brought_back(df: DataFrame, ranked: DataFrame, names: Sequence[str], name: str) -> DataFrame:
    """Give every row the ``name`` of its values; a value with very many rows may be split."""
    ranked = ranked.select(*(F.col(c).alias(f"__k{i}") for i, c in enumerate(names)), name)
    condition = None
    for i, column in enumerate(names):
        step = df[column].eqNullSafe(ranked[f"__k{i}"])
        condition = step if condition is None else condition & step
    return df.join(ranked, condition).drop(*(f"__k{i}" for i in range(len(names))))


def with_rank(df: DataFrame, track: Track, name: str = "rank") -> DataFrame:
    """Rank with gaps; the bucket may use keys and order column only."""
    counts, values = _values(df, track)
    ranked = with_running_sum(counts, values, F.col("__n"), "__upto")
    ranked = ranked.withColumn(name, F.col("__upto") - F.col("__n") + 1)
    return _brought_back(df, ranked, [*track.keys, track.order], name)


def with_dense_rank(df: DataFrame, track: Track, name: str = "dense_rank") -> DataFrame:
    """Rank without gaps, a NULL has one of its own; the bucket may use keys and order column only."""
    counts, values = _values(df, track)
    return _brought_back(df, with_row_number(counts, values, name), [*track.keys, track.order], name)


def with_running_sum(df: DataFrame, track: Track, value: Column, name: str = "running_sum") -> DataFrame:
    """Sum from the key's first row up to and including this one.

    NULL values add nothing; before the first value the sum is 0.
    """
    solid = F.coalesce(value, F.lit(0))

    def local(cut: _Cut) -> Column:
        frame = cut.within(track.total_order()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.sum(solid).over(frame)

    return _offset(df, track, name, local, F.sum(solid))


def _neighbour(df: DataFrame, track: Track, value: str, name: str, following: bool) -> DataFrame:
    """Value of the row before or after this one within the key.

    Only a bucket's edge row looks outside its bucket: it takes the nearest
    row of the neighbouring bucket that has rows at all.
    """
    if track.descending:
        raise ValueError("neighbours are defined on ascending tracks")
    pick, step = (F.min_by, F.lead) if following else (F.max_by, F.lag)
    cut = _Cut(df, track)
    # A struct around the value keeps a NULL value apart from "no row".
    edge = pick(F.struct(F.col(value).alias("v")), F.struct(track.order, *track.tiebreak))
    carry = step("__edge").over(cut.across())["v"].alias("__outside")
    inside = step(F.struct(F.col(value).alias("v"))).over(cut.within(track.total_order()))
    joined = cut.with_summary(inside, edge.alias("__edge"), carry)
    found = F.when(F.col("__local").isNotNull(), F.col("__local.v")).otherwise(F.col("__outside"))
    return joined.select(*df.columns, found.alias(name))


def with_previous(df: DataFrame, track: Track, value: str, name: str = "previous") -> DataFrame:
    return _neighbour(df, track, value, name, following=False)


def with_next(df: DataFrame, track: Track, value: str, name: str = "next") -> DataFrame:
    return _neighbour(df, track, value, name, following=True)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark applies the ``= 1`` limit in every map task before the shuffle, so a
    hot key sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def top_n(df: DataFrame, keys: Sequence[str], value: str, n: int, name: str = "rank") -> DataFrame:
    """Rows holding one of the key's ``n`` largest values, with dense rank.

    For values that rarely tie, such as sums. Spark applies the limit in every
    map task before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    return df.withColumn(name, F.dense_rank().over(w)).filter(F.col(name) <= n)


def top_n_with_ties(
    df: DataFrame, keys: Sequence[str], value: str, n: int, name: str = "rank"
) -> DataFrame:
    """All rows holding one of the key's ``n`` largest values, with dense rank.

    Ranks are computed over distinct values, so any number of tied rows joins
    back in parallel instead of being sorted in one task.
    """
    values = df.select(*keys, value).distinct()
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    ranked = values.withColumn(name, F.dense_rank().over(w)).filter(F.col(name) <= n)
    return _brought_back(df, ranked, [*keys, value], name)
