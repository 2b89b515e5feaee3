"""Every registered query equals its SQL twin at the smallest scale."""

import pytest

import __spark_entry__ as entry
from millrace.operators import aggregates, layout
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# At this scale no hour holds so many events.
MAY_BE_EMPTY = {"stream_burst", "stream_spike", "stream_spike_alerts", "stream_cancel_alert", "overbooked", "having_sql", "having_df"}


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, db, name):
    rows, problems = compare(spark, db, QUERIES[name], ORACLES[name], FOLDER)
    assert not problems
    assert rows or name in MAY_BE_EMPTY


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_partition_layouts_hold_every_row(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").count()
    frame = spark.read.parquet(f"{FOLDER}/orders.parquet")
    for spread in (layout.spread_evenly(frame, 8), layout.spread_by(frame, "o_custkey", partitions=8)):
        per_partition = aggregates.rows_per_partition(spread).collect()
        assert sum(r.n for r in per_partition) == orders
        assert len(per_partition) == 8


def test_entry_has_rows_and_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
