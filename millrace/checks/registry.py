"""Registered queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.session import configure
from millrace.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Reduce to 64-bit integers, doubles and text, which both engines share."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("long")
        elif isinstance(kind, (T.FloatType, T.DecimalType)):
            column = column.cast("double")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# Doubles in units of 2^-70, in which the given tables' values are whole numbers.
_UNITS = "1180591620717411303424.0"
_EXACT = (
    "list_transform([sum(CAST(CAST(({0}) AS DOUBLE) * " + _UNITS + " AS HUGEINT))], lambda s: "
    "list_transform([CAST(pow(2, greatest(0, floor(log2(greatest(abs(CAST(s AS DOUBLE)), 1))) - 60)) AS HUGEINT)], lambda p: "
    "CAST(sign(s) AS DOUBLE) * CAST(CAST(abs(s) // p // 2 * 2 "
    "+ CASE WHEN abs(s) % p <> 0 OR abs(s) // p % 2 = 1 THEN 1 ELSE 0 END AS BIGINT) AS DOUBLE) "
    "* CAST(p AS DOUBLE) / " + _UNITS + ")[1])[1]"
)


def with_exact_sums(sql: str) -> str:
    """Write ``exact_sum(x)`` out: whole units are summed, cut to 61 bits, of which the last tells of the rest, and rounded once."""
    start = sql.find("exact_sum(")
    while start >= 0:
        end, depth = start + len("exact_sum("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = sql[:start] + _EXACT.replace("{0}", sql[start + len("exact_sum(") : end - 1]) + sql[end:]
        start = sql.find("exact_sum(", start)
    return sql


def check(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with its SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(Tables(configure(spark), sf_dir)))

        if name in QUERIES:
            raise ValueError(f"duplicate check {name}")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = with_exact_sums(sql)
        return fn

    return register
