"""Booking state in the state store: any cut into batches, restarts, retries, and only what was touched is written."""

import random

import pytest
from pyspark.sql import Row, functions as F

from millrace.streaming import keyed, tables
from tests.test_streaming import fold, states

BUCKET = "date_trunc('minute', event_time)"
SCHEMA = "booking_id string, event_id long, step long, action string, item_id string, seats int"


def sequences(seed, bookings):
    rng = random.Random(seed)
    rows, expected = [], {}
    for b in range(bookings):
        actions = [f"{rng.choice(['BOOK', 'CANCEL'])} I{rng.randrange(9)} {rng.randrange(1, 5)}" for _ in range(rng.randrange(1, 9))]
        if fold(actions):
            expected[f"b{b}"] = fold(actions)
        for i, a in enumerate(actions):
            action, item, seats = a.split()
            rows.append((f"b{b}", len(rows), i, action, item, int(seats)))
    return rows, expected


def arrive(spark, rows, folder, low, high):
    part = spark.createDataFrame([r for r in rows if low <= r[2] < high], SCHEMA)
    part.withColumn("event_time", F.timestamp_seconds("step")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(SCHEMA + ", event_time timestamp").parquet(f"{folder}/in")


@pytest.fixture(scope="module")
def carried(spark, tmp_path_factory):
    """Four turns, each a restart of both queries from their checkpoints."""
    folder = str(tmp_path_factory.mktemp("keyed"))
    rows, expected = sequences(7, 50)
    for low, high in ((0, 1), (1, 3), (3, 5), (5, 9)):
        keyed.advance(spark, arrive(spark, rows, folder, low, high), f"{folder}/out", BUCKET)
    return rows, expected, f"{folder}/out"


def test_equals_the_fold_over_restarts(spark, carried):
    _, expected, out = carried
    assert states(keyed.current(spark, out)) == expected


def test_a_batch_writes_what_it_touches(spark, carried):
    rows, _, out = carried
    written = spark.read.parquet(f"{out}/state/data")
    for n, (low, high) in enumerate(((0, 1), (1, 3), (3, 5), (5, 9))):
        touched = {r[0] for r in rows if low <= r[2] < high}
        changed = {r.booking_id for r in written.filter(F.col("batch_id") == n).collect()}
        assert changed and changed <= touched


def test_effects_written_twice_count_once(spark, carried):
    """A retried batch writes its effects again under its number."""
    _, expected, out = carried
    again = spark.read.schema(keyed.EFFECTS).parquet(f"{out}/effects/data/batch_id=1")
    again.write.mode("append").parquet(f"{out}/effects/data/batch_id=1")
    tables.drain(tables.changes_table(keyed.state_changes(spark, out), f"{out}/state"), closing_batch=False)
    assert states(keyed.current(spark, out)) == expected


def test_several_effects_of_one_booking_at_once(spark, tmp_path):
    """The second query may fall behind: it takes the effects of many batches in their order."""
    rows, expected = sequences(11, 20)
    for step in range(9):
        part = arrive(spark, rows, str(tmp_path), step, step + 1)
        tables.drain(keyed.effects(part, f"{tmp_path}/out", BUCKET), closing_batch=False)
    tables.drain(tables.changes_table(keyed.state_changes(spark, f"{tmp_path}/out"), f"{tmp_path}/out/state"), closing_batch=False)
    assert states(keyed.current(spark, f"{tmp_path}/out")) == expected


def test_items_follow_their_bookings(spark, tmp_path):
    """Seats and cancellations per item after each turn, and only items of changed bookings are written."""
    rows, _ = sequences(5, 30)
    out = f"{tmp_path}/out"
    for turn, (low, high) in enumerate(((0, 2), (2, 4), (4, 9))):
        keyed.advance_items(spark, arrive(spark, rows, str(tmp_path), low, high), out, BUCKET)
        now = keyed.current(spark, out).collect()
        booked, cancelled = {}, {}
        for r in now:
            booked[r.item_id] = booked.get(r.item_id, 0) + (r.seats if r.status == "BOOKED" else 0)
            cancelled[r.item_id] = cancelled.get(r.item_id, 0) + (r.status == "CANCELLED")
        found = {r.item_id: (r.occupied, r.cancelled) for r in tables.read_latest(spark, f"{out}/items", keyed.ITEMS, ["item_id"]).collect()}
        assert {i: x for i, x in found.items() if x != (0, 0)} == {i: (booked[i], cancelled[i]) for i in booked if (booked[i], cancelled[i]) != (0, 0)}
        changes = spark.read.schema(keyed.CHANGES).parquet(f"{out}/state/data/batch_id={turn}").collect()
        touched = {x for r in changes for x in (r.item_id, r.was_item_id) if x}
        assert {r.item_id for r in spark.read.parquet(f"{out}/items/data/batch_id={turn}").collect()} <= touched
    inventory = spark.createDataFrame([("I1", "one", "BUS", 4), ("idle", "two", "BUS", 4)], "item_id string, item_name string, item_type string, capacity int")
    report = {r.item_id: r for r in keyed.occupancy(spark, inventory, out).collect()}
    assert (report["I1"].occupied, report["I1"].cancelled) == (booked.get("I1", 0), cancelled.get("I1", 0))
    assert (report["idle"].occupied, report["idle"].available, report["idle"].occupancy_pct) == (0, 4, 0.0)


def test_single_steps():
    book, other = {"item_id": "I1", "seats": 2}, {"item_id": "I2", "seats": 3}

    def effect(first=None, opened=None, last="BOOK", batch=0):
        return Row(first=first, open=opened, last_action=last, batch_id=batch)

    assert keyed.advanced(None, effect(last="CANCEL")) is None
    held = keyed.advanced(None, effect(first=book))
    assert held == ("I1", 2, "BOOKED", 0)
    assert keyed.advanced(held, effect(first=other, batch=0)) == held
    assert keyed.advanced(held, effect(first=other, batch=1)) == ("I1", 2, "BOOKED", 1)
    assert keyed.advanced(held, effect(first=other, last="CANCEL", batch=1)) == ("I1", 2, "CANCELLED", 1)
    assert keyed.advanced(held, effect(opened=other, batch=4)) == ("I2", 3, "BOOKED", 4)
