"""Spike alerts from chained aggregates against the plain rule, per key and over restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.streaming import alerts, tables, windows

START = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def expected(events, size, slide, mark, minimum, growth):
    counts = {}
    for key, at in events:
        last = at // slide * slide
        begin = last - (size // slide + 1) * slide
        for start in range(begin - begin % slide, last + 1, slide):
            if start <= at < start + size:
                counts[key, start] = counts.get((key, start), 0) + 1
    out = set()
    for (key, start), n in counts.items():
        before = counts.get((key, start - slide), 0)
        if start + size <= mark and n >= minimum and (before == 0 or n >= growth * before):
            out.add((key, start, n, before))
    return out


@pytest.mark.parametrize("size, slide", [(30, 10), (25, 10)])
def test_alerts_follow_the_rule_batch_by_batch(spark, tmp_path, size, slide):
    draw = random.Random(size)
    base = int(START.timestamp())
    # Bursts, a quiet stretch without any event, and a steady key.
    events = [("a", base + draw.randrange(0, 60)) for _ in range(30)]
    events += [("a", base + 200 + draw.randrange(0, 8)) for _ in range(12)]
    events += [(k, base + s) for s in range(0, 400, 7) for k in ("b", "c")]
    events += [("c", base + 300 + draw.randrange(0, 10)) for _ in range(25)]
    events.sort(key=lambda e: e[1])
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    seen, thirds = [], [events[: len(events) // 3], events[len(events) // 3 : -20], events[-20:]]
    for batch in thirds:
        seen += batch
        spark.createDataFrame(batch, "key string, at long").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("key string, at long").parquet(folder)
        stream = windows.timed(stream.withColumn("ts", F.timestamp_seconds("at")), "ts", "20 seconds")
        found = alerts.spike_alerts(stream, ["key"], f"{size} seconds", f"{slide} seconds", min_count=5, growth=2.0)
        tables.drain(tables.append_table(found, out))
        rows = tables.read_appended(spark, out).select("key", F.unix_seconds("window_start").alias("s"), "n", "previous")
        got = [tuple(r) for r in rows.collect()]
        assert len(got) == len(set(got))
        assert set(got) == expected(seen, size, slide, max(s for _, s in seen) - 20, 5, 2.0)
    assert {k for k, *_ in got} == {"a", "c"}
