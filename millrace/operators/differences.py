"""Where two tables differ, as multisets of rows, found by digests per part of the key space.

Each table is read once for its digests: rows are dealt to parts by a hash of
their key, and a part's digest is its number of rows and sums of two hashes of
whole rows, which depend on no order and count repeated rows. The driver sees
no rows; parts that agree are not looked at again. Only rows of parts that
differ are moved and compared exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

PARTS = 65536
_HALF = (1 << 32) - 1


def _part(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys, *(F.isnull(k) for k in keys)), F.lit(parts)).cast("int")


def part_digests(df: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """(part, rows, four sums) of every part that holds a row; a NULL and its place count."""
    cells = [F.col(f"`{c}`") for c in sorted(df.columns)]
    nulls = [F.isnull(c) for c in cells]
    one, two = F.xxhash64(*cells, *nulls), F.xxhash64(F.lit("second"), *cells, *nulls)
    # Halves of 32 bits, so that no sum overflows below some billions of rows a part.
    halves = [h for x in (one, two) for h in (F.shiftright(x, 32), x.bitwiseAND(F.lit(_HALF)))]
    sums = [F.sum(h).alias(f"sum{n}") for n, h in enumerate(halves)]
    return df.groupBy(_part(keys, parts).alias("part")).agg(F.count("*").alias("rows"), *sums)


def differing_parts(left: DataFrame, right: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """Numbers of the parts whose rows are not the same; at most ``parts`` of them."""
    names = ["rows", *(f"sum{n}" for n in range(4))]
    one, two = part_digests(left, keys, parts).alias("l"), part_digests(right, keys, parts).alias("r")
    same = [F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}")) for n in names]
    joined = one.join(two, F.col("l.part") == F.col("r.part"), "full")
    agree = same[0]
    for one_same in same[1:]:
        agree = agree & one_same
    return joined.filter(~agree).select(F.coalesce("l.part", "r.part").alias("part"))


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """Rows that one table holds more often than the other: its columns, ``side`` and ``surplus``.

    Both tables have the same columns, in any order. Rows are compared with
    NULLs equal, and repeated rows by their number.
    """
    if set(left.columns) != set(right.columns):
        raise ValueError(f"different columns: {sorted(set(left.columns) ^ set(right.columns))}")
    names = left.columns
    wanted = differing_parts(left, right, keys, parts)

    def suspect(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*(F.col(f"`{n}`") for n in names)).withColumn("__part", _part(keys, parts))
        # At most ``parts`` numbers, so every task may hold them all.
        return rows.join(F.broadcast(wanted), F.col("__part") == F.col("part"), "left_semi").drop("__part").withColumn("__sign", F.lit(sign))

    both = suspect(left, 1).union(suspect(right, -1))
    counted = both.groupBy(*(F.col(f"`{n}`") for n in names)).agg(F.sum("__sign").alias("surplus")).filter("surplus <> 0")
    side = F.when(F.col("surplus") > 0, "left").otherwise("right").alias("side")
    return counted.select(*(F.col(f"`{n}`") for n in names), side, F.abs("surplus").alias("surplus"))
