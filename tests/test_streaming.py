"""Micro-batches from hand-written files: order, late data, restarts."""

import time

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import bookings as booking_rules
from millrace.sources import streams
from millrace.streaming import accounts, bookings, logs, shop, tables, vitals, windows
from tests import fixtures


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()

    def put(name, *lines):
        # The file source orders files by modification time.
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
        time.sleep(0.05)

    return tmp_path, put


def lines(spark, root):
    return streams.line_stream(spark, f"{root}/in", files_per_batch=1)


def test_late_order_is_dropped_one_batch_after_the_watermark(spark, folder):
    root, put = folder
    for i, stamp in enumerate(("10:00:00", "10:10:00", "10:00:10", "10:00:20")):
        put(f"{i}.csv", f"O{i},C1,P1,1,10.0,2025-01-01 {stamp}")
    orders = streams.csv_stream(spark, f"{root}/in", schemas.ORDER_STREAM, files_per_batch=1)
    products = spark.createDataFrame([("P1", "pen", "office")], schemas.SHOP_PRODUCTS)
    revenue = shop.category_revenue(orders, products)
    tables.drain(tables.changes_table(revenue, f"{root}/out"))
    rows = tables.read_latest(spark, f"{root}/out", revenue.schema, ["window_start", "category"])
    found = {r.window_start.strftime("%H:%M:%S"): r.orders for r in rows.collect()}
    assert found == {"10:00:00": 2, "10:10:00": 1}


def test_running_totals_survive_a_restart(spark, folder):
    root, put = folder

    def run():
        totals = accounts.totals(accounts.parse(lines(spark, root), accounts.ACCOUNT_LINE))
        tables.drain(tables.changes_table(totals, f"{root}/out"))
        rows = tables.read_latest(spark, f"{root}/out", totals.schema, ["account"])
        return {r.account: (r.n, r.amount) for r in rows.collect()}

    put("1.txt", "A1 deposit 100", "A2 deposit 50", "A1 deposit NaN", "junk")
    assert run() == {"A1": (1, 100.0), "A2": (1, 50.0)}
    put("2.txt", "A1 withdraw 25.5")
    assert run() == {"A1": (2, 125.5), "A2": (1, 50.0)}
    assert run() == {"A1": (2, 125.5), "A2": (1, 50.0)}


def test_batch_against_running_total(spark, folder):
    root, put = folder
    put("1.txt", "A1 d 10", "A1 d 20", "A2 d 5")
    put("2.txt", "A2 d 7", "A3 d 1")
    entries = accounts.parse(lines(spark, root), accounts.ACCOUNT_LINE)
    tables.drain(
        tables.carried_state(entries, f"{root}/out", accounts.COMPARISON, accounts.compare_step, keep=None)
    )
    rows = tables.read_batches(spark, f"{root}/out", accounts.COMPARISON).collect()
    assert {(r.batch_id, r.account): (r.batch_n, r.total_n, float(r.total_amount)) for r in rows} == {
        (0, "A1"): (2, 2, 30.0), (0, "A2"): (1, 1, 5.0),
        (1, "A1"): (0, 2, 30.0), (1, "A2"): (1, 2, 12.0), (1, "A3"): (1, 1, 1.0),
    }


def test_log_reports_per_batch(spark, folder):
    root, put = folder
    put("1.txt", "2025-01-01 10:00:00 ERROR disk disk full", "2025-01-01 10:00:01 INFO ok", "", "short")
    put("2.txt", "2025-01-01 10:01:00 INFO ok ok")
    log = logs.parse_log(lines(spark, root))

    def batches(label, report):
        tables.drain(tables.batch_report(log, f"{root}/{label}", report))
        return spark.read.parquet(f"{root}/{label}/data").collect()

    assert {r.batch_id: r.errors for r in batches("errors", logs.batch_error_count)} == {0: 1, 1: 0}
    assert {(r.batch_id, r.level): r.n for r in batches("levels", logs.batch_level_counts)} == {
        (0, "ERROR"): 1, (0, "INFO"): 1, (1, "INFO"): 1,
    }
    words = batches("words", logs.batch_top_words)
    assert {r.word: r.n for r in words if r.batch_id == 0} == {"2025-01-01": 2, "disk": 2, "10:00:00": 1}
    assert len([r for r in words if r.batch_id == 0]) == 3


def test_spike_rules(spark):
    counts = {0: 2, 2: 8, 3: 16, 4: 17, 5: 7}  # window 1 is empty
    frame = spark.createDataFrame([(k, v) for k, v in counts.items()], "k long, n long").select(
        F.timestamp_seconds(F.col("k") * 10).alias("window_start"), "n"
    )
    found = windows.spikes(frame)
    assert {(r.window_start.second, r.n, r.previous) for r in found.collect()} == {(20, 8, 0), (30, 16, 8)}


EVENTS = {
    "b1": ["BOOK H01 2", "BOOK H02 9", "CANCEL H01 2"],
    "b2": ["CANCEL H01 1"],
    "b3": ["BOOK H01 1", "CANCEL H01 1", "CANCEL H01 1", "BOOK F01 3", "BOOK H02 4"],
    "b4": ["CANCEL H01 1", "BOOK B01 2", "BOOK H01 5"],
    "b5": ["BOOK H01 3", "CANCEL H01 3", "BOOK H02 1", "CANCEL H02 1"],
    "b6": ["BOOK H01 1"],
}


def fold(actions):
    """The booking rules, one event at a time."""
    state = None
    for action, item, seats in (a.split() for a in actions):
        if action == "BOOK" and (state is None or state[2] == "CANCELLED"):
            state = (item, int(seats), "BOOKED")
        elif action == "CANCEL" and state and state[2] == "BOOKED":
            state = (*state[:2], "CANCELLED")
    return state


EXPECTED = {b: s for b, s in ((b, fold(a)) for b, a in EVENTS.items()) if s}


def timeline():
    """(booking, position, time, action, item, seats), bookings interleaved."""
    rows, event_id = [], 0
    for step in range(max(map(len, EVENTS.values()))):
        for booking, actions in EVENTS.items():
            if step < len(actions):
                action, item, seats = actions[step].split()
                rows.append((booking, event_id, step, action, item, int(seats)))
                event_id += 1
    return rows


def states(frame):
    return {r.booking_id: (r.item_id, r.seats, r.status) for r in frame.collect()}


@pytest.mark.parametrize("bucket", ["event_time", "date_trunc('minute', event_time)", "date_trunc('day', event_time)"])
def test_booking_state_in_batch(spark, bucket):
    frame = spark.createDataFrame(
        timeline(), "booking_id string, event_id long, step long, action string, item_id string, seats int"
    ).withColumn("event_time", F.timestamp_seconds(F.col("step") * 25))
    assert states(booking_rules.booking_state(frame, bucket)) == EXPECTED


def test_random_booking_sequences_in_any_cut(spark):
    """Whatever the batch cuts, the carried state equals the event-by-event fold."""
    import random

    rng = random.Random(7)
    rows, expected = [], {}
    for b in range(60):
        actions = [f"{rng.choice(['BOOK', 'CANCEL'])} I{rng.randrange(9)} {rng.randrange(1, 5)}" for _ in range(rng.randrange(1, 9))]
        state = fold(actions)
        if state:
            expected[f"b{b}"] = state
        for i, a in enumerate(actions):
            action, item, seats = a.split()
            rows.append((f"b{b}", len(rows), i, rng.randrange(3), action, item, int(seats)))
    frame = spark.createDataFrame(
        rows, "booking_id string, event_id long, step long, r int, action string, item_id string, seats int"
    ).withColumn("event_time", F.timestamp_seconds("step"))
    step = bookings.state_step("date_trunc('minute', event_time)")
    state = None
    for low, high in ((0, 2), (2, 3), (3, 9)):
        state = step(state, frame.filter((F.col("step") >= low) & (F.col("step") < high)))
    assert states(state) == expected


def test_booking_monitor_over_batches(spark, folder):
    root, put = folder
    rows = timeline()
    for start in range(0, len(rows), 5):
        put(
            f"{start:03}.txt",
            *(f"{n}|{b}, hotel, {item}, {action.lower()}, {seats}" for b, n, _, action, item, seats in rows[start : start + 5]),
            "0|bad line",
            f"0|x{start}, hotel, NOPE, BOOK, 1",
        )
    inventory = spark.createDataFrame(fixtures.INVENTORY, schemas.INVENTORY)
    feed = streams.line_stream(spark, f"{root}/in", files_per_batch=1).select(
        F.substring_index("value", "|", -1).alias("value"),
        F.col("_metadata.file_modification_time").alias("event_time"),
        F.substring_index("value", "|", 1).cast("long").alias("event_id"),
    )
    events = bookings.known_items(bookings.parse(feed), inventory)
    tables.drain(bookings.monitor(events, inventory, f"{root}/out", "event_time"))
    last = (len(rows) - 1) // 5
    state = tables.read_state(spark, f"{root}/out", schemas.BOOKING_STATE, batch_id=last)
    assert states(state) == EXPECTED
    report = {r.item_id: r for r in spark.read.csv(f"{root}/out/occupancy", header=True).collect()}
    assert (report["F01"].occupied, report["F01"].available, report["F01"].occupancy_pct) == ("3", "9", "25.0")
    assert report["H01"].cancelled == "1" and report["H02"].cancelled == "1"
    by_type = {r.item_type: r.total_capacity for r in spark.read.csv(f"{root}/out/occupancy_by_type", header=True).collect()}
    assert by_type == {"HOTEL": "18", "FLIGHT": "12", "BUS": "6"}


def test_unknown_and_risky_branches(spark, folder):
    root, put = folder
    put("1.txt", "T1,A1,B03,debit,50000", "T2,A1,B03,debit,10", "T3,A1,B99,debit,1", "T4,A1,B01,debit,90000", "T5,,B01,debit,1")
    branches = spark.createDataFrame(fixtures.BRANCH_RISK, schemas.BRANCH_RISK)
    entries = accounts.parse(lines(spark, root), accounts.BANK_LINE)
    tables.drain(tables.append_table(accounts.with_branch(entries, branches), f"{root}/out"))
    rows = {r.txn_id: (r.branch_name, r.flag) for r in tables.read_appended(spark, f"{root}/out").collect()}
    assert rows == {
        "T1": ("Border Branch", "BIG AMOUNT"),
        "T2": ("Border Branch", ""),
        "T3": ("UNKNOWN", "UNKNOWN BRANCH"),
        "T4": ("Main Branch", ""),
    }


def test_repeated_vitals(spark, folder):
    root, put = folder
    for i in range(3):
        put(f"{i}.txt", "p1,150,95,100,98", "p2,70,95,100,98")
    feed = lines(spark, root).select("value", F.lit("2025-01-01 10:00:05").alias("at"))
    valid = vitals.readings(feed).filter("is_valid")
    repeated = vitals.repeated(vitals.alerts(windows.timed(valid, "at")))
    tables.drain(tables.changes_table(repeated, f"{root}/out"))
    rows = tables.read_latest(spark, f"{root}/out", repeated.schema, ["window_start", "patient_id"]).collect()
    assert {(r.patient_id, r.n) for r in rows} == {("p1", 3)}
    assert len(rows) == 3


def test_timed_run_stops(spark, folder):
    root, put = folder
    put("1.txt", "A1 d 10")
    totals = accounts.totals(accounts.parse(lines(spark, root), accounts.ACCOUNT_LINE))
    start = time.time()
    tables.run_for(tables.changes_table(totals, f"{root}/out"), seconds=8, every="1 second")
    assert time.time() - start < 30
    assert not [q for q in spark.streams.active]
    assert tables.read_latest(spark, f"{root}/out", totals.schema, ["account"]).first().n == 1
