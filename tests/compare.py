"""Compare registered queries with their SQL twins, by value and by type."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {"bigint": "BIGINT", "boolean": "BOOLEAN", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=0, abs_tol=0)
    return a == b and type(a) is type(b)


def compare(spark, db, query, sql: str, folder: str) -> tuple[int, list[str]]:
    """Row count and a list of differences (empty when equal)."""
    df = query(spark, folder)
    names = sorted(df.columns)
    problems = []
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    relation = db.execute(sql)
    oracle_kinds = {d[0]: str(d[1]) for d in relation.description}
    theirs = relation.fetchall()
    if sorted(oracle_kinds) != names:
        return 0, [f"columns {names} vs {sorted(oracle_kinds)}"]
    described = db.execute(f"DESCRIBE {sql}").fetchall()
    for name, kind in ((d[0], d[1]) for d in described):
        if KINDS.get(kinds[name]) != kind:
            problems.append(f"type of {name}: {kinds[name]} vs {kind}")
    mine = [tuple(r) for r in df.select(*names).collect()]
    order = [list(oracle_kinds).index(n) for n in names]
    theirs = [tuple(r[i] for i in order) for r in theirs]
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} vs {len(theirs)}")
    mine.sort(key=_key)
    theirs.sort(key=_key)
    bad = [(a, b) for a, b in zip(mine, theirs) if not all(_same(x, y) for x, y in zip(a, b))]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    return len(mine), problems


def main(folder: str, *wanted: str) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import test_session

    spark, db = test_session(), connect(folder)
    oracles, failures = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                rows, problems = compare(spark, db, query, oracles[name], folder)
            else:
                rows, problems = query(spark, folder).count(), []
        except Exception as error:  # report and go on with the next query
            rows, problems = 0, [str(error)[:int(os.environ.get('ERROR_CHARS', 300))]]
        failures += bool(problems)
        state = "FAIL" if problems else "ok" if rows else "EMPTY"
        print(f"{state:5} {name:24} rows={rows:<7} {time.time() - start:6.2f}s", *problems, flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
