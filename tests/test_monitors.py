"""Assembled monitors over two micro-batches of a file stream."""

import os

import pytest

from millrace import schemas
from millrace.streaming import accounts, logs, tables, vitals


@pytest.fixture()
def feed(spark, tmp_path):
    """A stream of text lines, one file a batch."""

    def make(*batches):
        (tmp_path / "in").mkdir()
        for n, lines in enumerate(batches):
            path = tmp_path / "in" / f"{n}.txt"
            path.write_text("\n".join(lines) + "\n")
            # Files arrive in the order of their times, which must differ.
            os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
        return spark.readStream.option("maxFilesPerTrigger", 1).schema(schemas.LINES).text(str(tmp_path / "in"))

    return make


def test_vitals_counters_and_alerts(spark, feed, tmp_path):
    stream = feed(["p1,130,95,100,98.6", "p2,x,95,100,98"], ["p1,70,95,100,98.6", "p3,70,80,100,98.6"])
    query = vitals.monitor(stream, f"{tmp_path}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    seen = [p["observedMetrics"]["vitals"] for p in query.recentProgress if "vitals" in p["observedMetrics"]]
    assert {k: sum(dict(zip(("total", "invalid", "abnormal"), m.values() if isinstance(m, dict) else m))[k] for m in seen)
            for k in ("total", "invalid", "abnormal")} == {"total": 4, "invalid": 1, "abnormal": 2}
    found = spark.read.parquet(f"{tmp_path}/out/data").collect()
    assert sorted((r.patient_id, r.reasons) for r in found) == [("p1", "HeartRate=130"), ("p3", "SpO2=80")]


def test_account_monitor(spark, feed, tmp_path):
    branches = spark.createDataFrame([("B1", "one", "x", "HIGH")], "branch_id string, branch_name string, city string, risk_level string")
    stream = feed(["t1,A1,B1,deposit,60000", "t2,A2,B9,deposit,5"], ["t3,A1,B1,deposit,0.125"])
    tables.drain(accounts.monitor(stream, branches, f"{tmp_path}/out"))
    flagged = spark.read.parquet(f"{tmp_path}/out/flagged").collect()
    assert sorted((r.txn_id, r.flag) for r in flagged) == [("t1", "BIG AMOUNT"), ("t2", "UNKNOWN BRANCH")]
    state = tables.read_state(spark, f"{tmp_path}/out", accounts.COMPARISON, 1).collect()
    assert sorted((r.account, r.batch_n, r.total_n, float(r.total_amount)) for r in state) == [("A1", 1, 2, 60000.125), ("A2", 0, 1, 5.0)]


def test_log_monitor(spark, feed, tmp_path):
    stream = feed(["2025-01-01 10:00:00 ERROR disk full", "2025-01-01 10:00:01 INFO up"], ["2025-01-01 10:00:02 ERROR disk"])
    tables.drain(logs.monitor(logs.parse_log(stream, None), f"{tmp_path}/out"))
    errors = spark.read.parquet(f"{tmp_path}/out/errors").collect()
    assert sorted((r.batch_id, r.errors) for r in errors) == [(0, 1), (1, 1)]
    levels = spark.read.parquet(f"{tmp_path}/out/levels").collect()
    assert sorted((r.batch_id, r.level, r.n) for r in levels) == [(0, "ERROR", 1), (0, "INFO", 1), (1, "ERROR", 1)]
