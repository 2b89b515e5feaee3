"""Batch against total in the state store: restarts, retries, any doubles, and only touched keys written."""

import math
import os

import pytest
from pyspark.sql import functions as F

from millrace.streaming import comparing, tables

SCHEMA = "account string, amount double"
BATCHES = [
    [("a", 1 / 3), ("a", 1e15), ("b", 5.0)],
    [("b", 1e-9), ("c", None)],
    [("a", -1e15), ("d", 0.1), ("d", 0.2), (None, 2.0)],
]


def arrive(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")


def expected(upto):
    seen = [row for batch in BATCHES[: upto + 1] for row in batch]
    out = {}
    for key in {k for k, _ in seen}:
        amounts = [x for k, x in seen if k == key and x is not None]
        now = sum(k == key for k, _ in BATCHES[upto])
        out[key] = (now, sum(k == key for k, _ in seen), math.fsum(amounts) if amounts else None)
    return out


def report(spark, out):
    rows = comparing.compared(spark, out).collect()
    found = {r.account: (r.batch_n, r.total_n, r.total_amount) for r in rows}
    assert len(found) == len(rows)
    return {r.batch_id for r in rows}, found


@pytest.fixture(scope="module")
def reports(spark, tmp_path_factory):
    """A report after each batch; every batch restarts both queries."""
    folder, found = str(tmp_path_factory.mktemp("comparing")), []
    for batch in BATCHES:
        comparing.advance(spark, arrive(spark, batch, folder), f"{folder}/out")
        found.append(report(spark, f"{folder}/out"))
    return folder, found


def test_every_batch_against_all_so_far(reports):
    for n, (batches, found) in enumerate(reports[1]):
        assert batches == {n}
        assert found == expected(n)


def test_a_batch_writes_its_own_keys(spark, reports):
    written = spark.read.parquet(f"{reports[0]}/out/totals/data")
    for n, batch in enumerate(BATCHES):
        assert {r.key for r in written.filter(F.col("batch_id") == n).collect()} == {k for k, _ in batch}


def test_a_retried_batch_counts_once(spark, reports):
    """The first query is ended between its last write and its commit, and runs again."""
    folder = reports[0]
    commits = f"{folder}/out/sums/checkpoint/commits"
    for name in ("2", ".2.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    comparing.advance(spark, stream, f"{folder}/out")
    assert os.path.exists(f"{commits}/2")
    assert report(spark, f"{folder}/out") == ({2}, expected(2))


def test_the_second_query_may_fall_behind(spark, tmp_path):
    for batch in BATCHES:
        tables.drain(comparing.batch_sums(arrive(spark, batch, tmp_path), f"{tmp_path}/out"), closing_batch=False)
    tables.drain(comparing.steps(spark, None, f"{tmp_path}/out")[1](), closing_batch=False)
    assert report(spark, f"{tmp_path}/out") == ({2}, expected(2))
