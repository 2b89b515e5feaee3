"""Every byte of a bad file is in one of two tables; sketches merge over batches."""

from pyspark.sql import functions as F, types as T

from millrace.sources import placed
from millrace.streaming import distinct, tables, windows

SCHEMA = T.StructType().add("id", T.LongType()).add("amount", T.DoubleType()).add("name", T.StringType())


def test_csv_lines_are_records_or_rejects(spark, tmp_path):
    good = [b"1,2.5,one", b'2,,"two, quoted"', b"3,1e3,three\r"]
    bad = {
        placed.NOT_UTF8: [b"4,1.0,\xff\xfe"],
        placed.EMPTY: [b"", b" \t\r"],
        placed.UNFIT: [b"x,1.0,no number", b"5,1.0", b"6,1.0,six,more", b"7,much,seven\r"],
    }
    data = b"\n".join([b"id,amount,name", *good, *(line for lines in bad.values() for line in lines)]) + b"\n"
    (tmp_path / "feed.csv").write_bytes(data)
    marked = placed.placed_csv(spark, str(tmp_path), SCHEMA, header=True)
    kept = {tuple(r) for r in placed.records(marked).collect()}
    assert kept == {(1, 2.5, "one"), (2, None, "two, quoted"), (3, 1000.0, "three")}
    assert placed.records(marked).columns == SCHEMA.names
    found = placed.rejects(marked).collect()
    assert sorted((r.reason, bytes(r.raw)) for r in found) == sorted((k, line) for k, lines in bad.items() for line in lines)
    assert all(r.file.endswith("feed.csv") and r.block_start == 0 for r in found)
    every = placed.placed_csv(spark, str(tmp_path), SCHEMA).agg(F.sum(F.octet_length(F.col("value").cast("binary")) + 1)).first()[0]
    assert every == len(data)


def test_json_lines_are_records_or_rejects(spark, tmp_path):
    good = [b'{"id": 1, "amount": 2.5, "name": "one"}', b'{"id": 2, "other": true}\r']
    bad = [b'{"id": 3', b'{"id": "x"}', b"plain words", b"7", b"", b'{"name": "\xff"}']
    (tmp_path / "feed.json").write_bytes(b"\n".join(good + bad))
    marked = placed.placed_json(spark, str(tmp_path), SCHEMA)
    assert {tuple(r) for r in placed.records(marked).collect()} == {(1, 2.5, "one"), (2, None, None)}
    assert sorted(bytes(r.raw) for r in placed.rejects(marked).collect()) == sorted(bad)


def test_sketches_over_batches_merge_within_their_error(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(60_000).select(
        F.timestamp_seconds(F.col("id") % 7200).alias("event_time"),
        F.when(F.col("id") % 11 > 0, F.col("id") * 37 % 25_000).alias("user"),
    )
    for turn in range(3):
        rows.filter(F.pmod(F.xxhash64("user"), F.lit(3)) == turn).write.mode("append").parquet(folder)
        stream = windows.timed(spark.readStream.schema(rows.schema).parquet(folder), "event_time", "3 hours")
        found = distinct.sketches(stream, "user", size="1 hour")
        tables.drain(tables.changes_table(found, out), closing_batch=False)
    latest = tables.read_latest(spark, out, found.schema, ["window_start"])
    exact = rows.groupBy(F.window("event_time", "1 hour").start.alias("window_start")).agg(F.count_distinct("user").alias("n"))
    both = distinct.estimates(latest, ["window_start"]).join(exact, "window_start").collect()
    assert len(both) == 2 and all(abs(r.n_distinct - r.n) <= distinct.relative_error() * r.n for r in both)
    total, n = distinct.estimates(latest, []).first()[0], rows.select("user").na.drop().distinct().count()
    assert abs(total - n) <= distinct.relative_error() * n
