"""Compacted result tables, panes and late rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.layout import plan_text
from millrace.streaming import accounts, late, panes, tables, windows

SCHEMA = "k string, v long"


def put(spark, out, batch, *rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{out}/data/batch_id={batch}")


def latest(spark, out):
    kinds = spark.createDataFrame([], SCHEMA).schema
    return {r.k: r.v for r in tables.read_latest(spark, out, kinds, ["k"]).collect()}


def fold(spark, out, upto=None):
    return tables.compact(spark, out, spark.createDataFrame([], SCHEMA).schema, ["k"], upto)


def test_base_and_batches(spark, tmp_path):
    out = str(tmp_path)
    assert fold(spark, out) is None and latest(spark, out) == {}
    for n in range(5):
        put(spark, out, n, ("a", n), (f"only{n}", n))
    before = latest(spark, out)
    assert before["a"] == 4 and before["only0"] == 0
    assert fold(spark, out, upto=3) == 3 and latest(spark, out) == before
    assert tables._numbered(spark, f"{out}/data", "batch_id") == [4]
    put(spark, out, 5, ("only1", 50))
    assert fold(spark, out) == 5 and latest(spark, out) == {**before, "only1": 50}
    assert fold(spark, out) == 5 and tables._numbered(spark, f"{out}/base", "upto") == [5]


def test_crash_between_the_two_writes(spark, tmp_path):
    """A base without its mark is not used; batches left behind by a crash after the mark are not read twice."""
    out = str(tmp_path)
    for n in range(3):
        put(spark, out, n, ("a", n))
    half = tmp_path / "base" / "upto=2"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"cut off")
    assert latest(spark, out) == {"a": 2}
    assert fold(spark, out) == 2 and latest(spark, out) == {"a": 2}
    put(spark, out, 1, ("a", 99))
    assert latest(spark, out) == {"a": 2}
    assert fold(spark, out) == 2 and tables._numbered(spark, f"{out}/data", "batch_id") == []


def test_many_batches_read_few_files(spark, tmp_path):
    out = str(tmp_path)
    (tmp_path / "in").mkdir()
    for n in range(40):
        (tmp_path / "in" / f"{n:03}.txt").write_text(f"k{n % 3}\n")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{out}/in")
    counts = stream.groupBy(F.col("value").alias("k")).agg(F.count("*").alias("v"))
    tables.drain(tables.changes_table(counts, f"{out}/t", ["k"], compact_every=8), closing_batch=False)
    assert len(tables._numbered(spark, f"{out}/t/data", "batch_id")) <= 9
    found = tables.read_latest(spark, f"{out}/t", counts.schema, ["k"])
    assert {r.k: r.v for r in found.collect()} == {"k0": 14, "k1": 13, "k2": 13}
    assert len({name.rpartition("/")[0] for name in found.inputFiles()}) <= 9


def at(seconds):
    return datetime.datetime(2025, 1, 1) + datetime.timedelta(seconds=seconds)


def test_panes_equal_sliding_windows_and_copy_no_row(spark):
    rows = spark.range(500).select(
        (F.col("id") % 3).alias("k"), (F.xxhash64("id") % 1000 / 7).alias("amount"), F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9000))).alias("event_time")
    )
    found = panes.panes(rows, ["k"], "amount", "5 minutes")
    got = panes.over_panes(found, ["k"], "30 minutes", "5 minutes", total="total")
    whole = windows.windowed(rows, [F.count("*").alias("n"), F.sum("amount").alias("plain")], ["k"], "30 minutes", "5 minutes")
    both = got.join(whole.withColumnRenamed("n", "m"), ["window_start", "window_end", "k"], "full")
    assert both.filter("NOT (n <=> m) OR abs(total - plain) > 1e-6 OR total IS NULL OR plain IS NULL").count() == 0
    assert "Expand" not in plan_text(found) and "Expand" in plan_text(whole)
    with pytest.raises(ValueError):
        panes.over_panes(found, ["k"], "12 minutes", "5 minutes")


def test_bursts_come_from_panes(spark):
    rows = [("a", s) for s in (0, 3500, 3700, 10700, 10900)] + [("b", 50), ("b", 7300), ("b", 90000)] + [("c", 40)] * 3 + [("d", 40000 + 3600 * n) for n in range(9)]
    entries = spark.createDataFrame([(k, n + 0.25, at(s)) for n, (k, s) in enumerate(rows)], "account string, amount double, event_time timestamp")
    found = accounts.burst_panes(entries, slide="1 hour")
    # The stream keeps one row a key and hour, and copies none into the windows that share it.
    assert "Expand" not in plan_text(found) and found.count() == len({(k, s // 3600) for k, s in rows})
    got = accounts.bursts(found, limit=3, size="3 hours", slide="1 hour")
    measures = [F.count("*").alias("n"), F.sum("amount").alias("amount")]
    whole = windows.windowed(entries, measures, ["account"], "3 hours", "1 hour").filter("n >= 3")
    assert got.columns == whole.columns and sorted(got.collect()) == sorted(whole.collect())
    assert {r.account for r in got.collect()} == {"a", "c", "d"}


def test_late_rows_are_listed_with_their_mark(spark, tmp_path):
    out, schema = str(tmp_path), "id long, event_time timestamp"
    batches = [[(1, at(0)), (2, at(100))], [(3, at(5)), (4, at(400)), (9, None)], [(5, at(70)), (6, at(130)), (7, at(390))], [(8, at(389)), (10, at(20))]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema(schema).parquet(f"{out}/in")
        tables.drain(late.split(stream, f"{out}/r", size="1 minute", delay="1 minute"))
    marks = {r.id: (r.batch_id, r.judged_by) for r in late.late_rows(spark, f"{out}/r").collect()}
    # After 100 s the mark is 40 s, after 400 s it is 340 s; a row is late once its minute is over by then.
    assert marks == {9: (1, at(40)), 5: (2, at(340)), 6: (2, at(340)), 10: (3, at(340))}
    found = {r.window_start: (r.on_time, r.late) for r in late.reconciled(spark, f"{out}/r", "1 minute").collect()}
    assert found == {at(0): (2, 1), at(60): (1, 1), at(120): (0, 1), at(360): (3, 0), None: (0, 1)}
