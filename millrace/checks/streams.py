"""Streaming checks: the given tables as file streams, results read back."""

from pyspark.sql import functions as F

from millrace.checks import roles
from millrace.checks.registry import check
from millrace.functions import rules
from millrace.session import fresh_folder
from millrace.sources import growing
from millrace.streaming import accounts, alerts, bookings, comparing, distinct, keyed, late, logs, panes, shop, tables, vitals, windows


def _table(t, label, aggregate, keys):
    """Drain an update-mode aggregate and read the last value per key."""
    out = fresh_folder(t.spark, label)
    tables.drain(tables.changes_table(aggregate, out), closing_batch=False)
    return tables.read_latest(t.spark, out, aggregate.schema, keys)


def _appended(t, label, stream):
    out = fresh_folder(t.spark, label)
    tables.drain(tables.append_table(stream, out))
    return tables.read_appended(t.spark, out)


def _in_turns(t, label, name, order, turns, start):
    """Let a table arrive in ``turns`` slices of its order column.

    Each slice is appended to a folder and drained before the next one
    arrives, so one slice is one micro-batch; every turn also restarts the
    query from its checkpoint. ``start(stream, out)`` builds the writer, or
    does the whole turn and gives None.
    """
    out = fresh_folder(t.spark, label)
    source = getattr(t, name).withColumn("__at", order)
    low, high = source.agg(F.min("__at"), F.max("__at")).first()
    width = high - low + 1
    for turn in range(turns):
        first = low + -(-turn * width // turns)
        last = low + -(-(turn + 1) * width // turns)
        arrived = source.filter((F.col("__at") >= first) & (F.col("__at") < last)).drop("__at")
        arrived.write.mode("append").parquet(f"{out}/landing")
        stream = t.spark.readStream.schema(arrived.schema).parquet(f"{out}/landing")
        writer = start(stream, f"{out}/result")
        if writer is not None:
            tables.drain(writer)
    return f"{out}/result"



def _in_batches(t, label, name, order, aggregate, keys, turns=3):
    """Last value per key of an update-mode aggregate over ``turns`` micro-batches, with a restart before each."""
    kinds = []

    def start(stream, out):
        changed = aggregate(stream)
        kinds[:] = [changed.schema]
        tables.drain(tables.changes_table(changed, out), closing_batch=False)

    out = _in_turns(t, label, name, order, turns, start)
    return tables.read_latest(t.spark, out, kinds[0], keys)


def _events_in_batches(t, label, aggregate, keys):
    return _in_batches(t, label, "events", _micros(), aggregate, keys)


def _micros():
    return F.unix_micros(F.col("ts").cast("timestamp"))


def _turn_sql(table, order, turns):
    return (
        f"least({turns - 1}, (({order}) - (SELECT min({order}) FROM {table})) * {turns} "
        f"// (SELECT max({order}) - min({order}) + 1 FROM {table}))"
    )


_EVENT_TURN = _turn_sql("events", "epoch_us(ts)", 3)


def _window_sql(source, size, slide, keys, measures, having=""):
    """Windowed aggregate over ``source`` (columns ts, keys); seconds."""
    group = ", ".join(["ws", *keys])
    size_us, slide_us = size * 1000000, slide * 1000000
    return f"""
    SELECT strftime(make_timestamp(ws), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(make_timestamp(ws + {size_us}), '%Y-%m-%d %H:%M:%S') AS window_end,
           {", ".join([*keys, *measures])}
    FROM (SELECT *, (epoch_us(ts) // {slide_us} - k) * {slide_us} AS ws
          FROM (SELECT *, unnest(range(0, {size} // {slide})) AS k FROM ({source})))
    GROUP BY {group} {having}"""


_SUM = "exact_sum(amount)"
HOUR, DAY = 3600, 86400


# --- logs -------------------------------------------------------------------

_LOG_SQL = "SELECT ts, upper(event_type) AS level FROM events"


def _log(events):
    return logs.parse_log(events.select(roles.stamped_line().alias("value")))


@check(
    "stream_error_count",
    _window_sql(_LOG_SQL, HOUR, HOUR, [], ["count(CASE WHEN level = 'ERROR' THEN 1 END) AS errors"]),
)
def stream_error_count(t):
    return _events_in_batches(t, "error-count", lambda events: logs.error_counts(_log(events), "1 hour"), ["window_start"])


@check("stream_level_count", _window_sql(_LOG_SQL, DAY, DAY, ["level"], ["count(*) AS n"]))
def stream_level_count(t):
    return _events_in_batches(t, "level-count", lambda events: logs.level_counts(_log(events), "1 day"), ["window_start", "level"])


@check(
    "stream_growing_lines",
    "SELECT level, count(*) AS n, count(DISTINCT date_trunc('second', ts)) AS seconds FROM (" + _LOG_SQL + ") GROUP BY level",
)
def stream_growing_lines(t):
    """Log files that come in three turns, followed by byte offsets over two restarts."""
    out = fresh_folder(t.spark, "growing-lines")
    for turn in range(3):
        events = t.events.filter(F.pmod("event_id", F.lit(3)) == turn)
        lines = events.select(roles.stamped_line().alias("value"))
        lines.write.mode("append").text(f"{out}/landing")
        followed = growing.growing_lines(t.spark, f"{out}/landing", piece_bytes=1 << 20)
        tables.drain(tables.append_table(logs.parse_log(followed, None), f"{out}/result"))
    found = tables.read_appended(t.spark, f"{out}/result")
    return found.groupBy("level").agg(F.count("*").alias("n"), F.count_distinct("event_time").alias("seconds"))


@check(
    "stream_top_words",
    rf"""
    WITH words AS (
      SELECT {_turn_sql("documents", "doc_id", 3)} AS batch_id,
             unnest(string_split_regex(text, '\s+')) AS word FROM documents),
    counted AS (SELECT batch_id, word, count(*) AS n FROM words WHERE word <> '' GROUP BY 1, 2)
    SELECT batch_id, word, n
    FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, word) AS rn FROM counted)
    WHERE rn <= 3""",
)
def stream_top_words(t):
    def start(stream, out):
        return tables.batch_report(stream, out, lambda batch: logs.batch_top_words(batch, "text"))

    out = _in_turns(t, "top-words", "documents", F.col("doc_id"), 3, start)
    return t.spark.read.parquet(f"{out}/data")


# --- accounts ---------------------------------------------------------------

# Event 53n has no number, 59n a negative amount, 61n a field too few; some
# amounts are zero as given.
_ENTRIES_SQL = """
    SELECT ts, event_id, CAST(user_id AS VARCHAR) AS account, value AS amount,
           CAST(user_id % 30 AS VARCHAR) AS branch_id, event_type AS store
    FROM events WHERE event_id % 53 <> 0 AND event_id % 59 <> 0 AND event_id % 61 <> 0
          AND value > 0"""


def _entry_lines(events, fields, delimiter):
    key = F.col("event_id")
    amount = (
        F.when(key % 53 == 0, "NaN")
        .when(key % 59 == 0, "-1")
        .otherwise(F.col("value").cast("string"))
    )
    head = F.concat_ws(delimiter, *fields)
    line = F.when(key % 61 == 0, head).otherwise(F.concat_ws(delimiter, head, amount))
    return events.select("ts", "event_id", line.alias("value"))


def _account_entries(events):
    lines = _entry_lines(events, [F.col("user_id"), F.col("event_type")], " ")
    return accounts.parse(lines, accounts.ACCOUNT_LINE)


def _store_entries(events):
    lines = _entry_lines(events, [F.col("event_id"), F.col("event_type")], "  ")
    return windows.timed(accounts.parse(lines, accounts.STORE_LINE), "ts")


def _panes(t, label, keys, amount, slide):
    """Panes of store entries, over three micro-batches."""

    def aggregate(events):
        return panes.panes(_store_entries(events), keys, amount, slide)

    return _events_in_batches(t, label, aggregate, ["pane", *keys])


def _bank_entries(events):
    fields = [F.col("event_id"), F.col("user_id"), F.col("user_id") % 30, F.col("event_type")]
    lines = _entry_lines(events, fields, ", ")
    return accounts.parse(lines, accounts.BANK_LINE)


@check(
    "stream_batch_totals",
    f"""
    SELECT {_EVENT_TURN} AS batch_id, account, count(*) AS n, {_SUM} AS amount
    FROM ({_ENTRIES_SQL}) GROUP BY 1, 2""",
)
def stream_batch_totals(t):
    def start(stream, out):
        return tables.batch_report(_account_entries(stream), out, accounts.totals)

    out = _in_turns(t, "batch-totals", "events", _micros(), 3, start)
    return t.spark.read.parquet(f"{out}/data")


@check("stream_running_totals", f"SELECT account, count(*) AS n, {_SUM} AS amount FROM ({_ENTRIES_SQL}) GROUP BY 1")
def stream_running_totals(t):
    return _table(t, "running-totals", accounts.totals(_account_entries(t.stream("events"))), ["account"])


@check(
    "stream_compare",
    f"""
    WITH turned AS (SELECT *, {_EVENT_TURN} AS turn FROM ({_ENTRIES_SQL})),
    per AS (SELECT turn, account, count(*) AS n, sum(CAST(amount AS DECIMAL(18,2))) AS a FROM turned GROUP BY 1, 2),
    grid AS (SELECT account, unnest(range(min(turn), 3)) AS batch_id FROM per GROUP BY 1)
    SELECT g.batch_id, g.account, CAST(coalesce(p.n, 0) AS BIGINT) AS batch_n,
           CAST(sum(coalesce(p.n, 0)) OVER w AS BIGINT) AS total_n,
           CAST(sum(coalesce(p.a, 0)) OVER w AS DOUBLE) AS total_amount
    FROM grid g LEFT JOIN per p ON p.turn = g.batch_id AND p.account = g.account
    WINDOW w AS (PARTITION BY g.account ORDER BY g.batch_id)""",
)
def stream_compare(t):
    def start(stream, out):
        entries = _account_entries(stream)
        return tables.carried_state(entries, out, accounts.COMPARISON, accounts.compare_step, keep=None)

    out = _in_turns(t, "compare", "events", _micros(), 3, start)
    return tables.read_batches(t.spark, out, accounts.COMPARISON)


@check(
    "stream_compare_keyed",
    f"""
    WITH turned AS (SELECT *, {_EVENT_TURN} AS turn FROM ({_ENTRIES_SQL})),
    grid AS (SELECT account, unnest(range(min(turn), 3)) AS batch_id FROM turned GROUP BY 1)
    SELECT g.batch_id, g.account, CAST(count(*) FILTER (t.turn = g.batch_id) AS BIGINT) AS batch_n,
           count(*) AS total_n, {_SUM} AS total_amount
    FROM grid g JOIN turned t ON t.account = g.account AND t.turn <= g.batch_id
    GROUP BY g.batch_id, g.account""",
)
def stream_compare_keyed(t):
    """The reports after each of three batches; the totals stay in the state store."""
    reports = []

    def start(stream, out):
        comparing.advance(t.spark, _account_entries(stream), out)
        report = comparing.compared(t.spark, out)
        report.write.parquet(f"{out}/reports/turn={len(reports)}")
        reports.append(report.schema)

    out = _in_turns(t, "compare-keyed", "events", _micros(), 3, start)
    return t.spark.read.schema(reports[0]).parquet(f"{out}/reports/*")


@check(
    "stream_sliding_count",
    _window_sql(_ENTRIES_SQL, HOUR, HOUR // 6, [], ["count(*) AS n"]),
)
def stream_sliding_count(t):
    found = _panes(t, "sliding-count", [], None, "10 minutes")
    return panes.over_panes(found, [], "1 hour", "10 minutes")


@check(
    "stream_sliding_sum",
    _window_sql(_ENTRIES_SQL, 6 * HOUR, HOUR, ["store"], [f"{_SUM} AS total"]),
)
def stream_sliding_sum(t):
    found = _panes(t, "sliding-sum", ["store"], "amount", "1 hour")
    return panes.over_panes(found, ["store"], "6 hours", "1 hour", count=None, total="total")


@check(
    "stream_sliding_total",
    _window_sql(_ENTRIES_SQL, 6 * HOUR, HOUR, [], [f"{_SUM} AS total"]),
)
def stream_sliding_total(t):
    found = _panes(t, "sliding-total", [], "amount", "1 hour")
    return panes.over_panes(found, [], "6 hours", "1 hour", count=None, total="total")


@check(
    "stream_spike",
    f"""
    WITH counts AS ({_window_sql(_ENTRIES_SQL, 900, 300, [], ["count(*) AS n", "ws"])})
    SELECT c.window_start, c.window_end, c.n, coalesce(p.n, 0) AS previous
    FROM counts c LEFT JOIN counts p ON p.ws = c.ws - 300 * 1000000
    WHERE c.n >= 8 AND (coalesce(p.n, 0) = 0 OR c.n >= 2.0 * p.n)""",
)
def stream_spike(t):
    counts = windows.sliding_counts(_store_entries(t.stream("events")), "15 minutes", "5 minutes")
    return windows.spikes(_table(t, "spike", counts, ["window_start"]), "5 minutes")


@check(
    "stream_spike_alerts",
    f"""
    WITH counts AS ({_window_sql(_ENTRIES_SQL, 900, 300, [], ["count(*) AS n", "ws"])}),
    mark AS (SELECT max(epoch_us(ts)) // 1000 * 1000 - 600 * 1000000 AS us FROM ({_ENTRIES_SQL}))
    SELECT c.window_start, c.window_end, c.n, coalesce(p.n, 0) AS previous
    FROM counts c LEFT JOIN counts p ON p.ws = c.ws - 300 * 1000000
    WHERE c.n >= 8 AND (coalesce(p.n, 0) = 0 OR c.n >= 2.0 * p.n)
          AND c.ws + 900 * 1000000 <= (SELECT us FROM mark)""",
)
def stream_spike_alerts(t):
    """Alerts as the stream gives them: of the windows that the watermark has closed."""

    def start(stream, out):
        entries = accounts.parse(_entry_lines(stream, [F.col("event_id"), F.col("event_type")], "  "), accounts.STORE_LINE)
        found = alerts.spike_alerts(windows.timed(entries, "ts", "10 minutes"), size="15 minutes", slide="5 minutes")
        return tables.append_table(found, out)

    return tables.read_appended(t.spark, _in_turns(t, "spike-alerts", "events", _micros(), 3, start))


@check(
    "stream_enrich",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS txn_id, account, coalesce(n_name, 'UNKNOWN') AS branch_name,
           coalesce(r_name, 'UNKNOWN') AS city,
           CASE WHEN n_name IS NULL THEN 'UNKNOWN' WHEN n_regionkey = 0 THEN 'HIGH' ELSE 'LOW' END AS risk_level,
           amount,
           CASE WHEN n_name IS NULL THEN 'UNKNOWN BRANCH'
                WHEN n_regionkey = 0 AND amount >= 100 THEN 'BIG AMOUNT' ELSE '' END AS flag
    FROM ({_ENTRIES_SQL}) LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey)
         ON branch_id = CAST(n_nationkey AS VARCHAR)""",
)
def stream_enrich(t):
    branches = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("branch_id"),
        F.col("n_name").alias("branch_name"),
        F.col("r_name").alias("city"),
        F.when(F.col("n_regionkey") == 0, "HIGH").otherwise("LOW").alias("risk_level"),
    )
    enriched = accounts.with_branch(_bank_entries(t.stream("events")), branches, big_amount=100)
    columns = ("txn_id", "account", "branch_name", "city", "risk_level", "amount", "flag")
    return _appended(t, "enrich", enriched.select(*columns))


@check(
    "stream_burst",
    _window_sql(
        _ENTRIES_SQL, 6 * HOUR, HOUR, ["account"], ["count(*) AS n", f"{_SUM} AS amount"], "HAVING count(*) >= 5"
    ),
)
def stream_burst(t):
    def aggregate(events):
        entries = windows.timed(_bank_entries(events), "ts")
        return accounts.burst_panes(entries, slide="1 hour")

    found = _events_in_batches(t, "burst", aggregate, ["pane", "account"])
    return accounts.bursts(found, limit=5, size="6 hours", slide="1 hour")


# Every 17th event arrives one slice late and every 29th two slices; the last slice takes the rest.
_TURNS = 6
_SLICE = _turn_sql("events", "epoch_us(ts)", _TURNS)
_LATE_SQL = f"""
    WITH arrived AS (
      SELECT *, least({_TURNS - 1}, {_SLICE} + CASE WHEN event_id % 29 = 0 THEN 2 WHEN event_id % 17 = 0 THEN 1 ELSE 0 END) AS turn
      FROM events
    ), marks AS (
      SELECT t.turn, (SELECT max(epoch_us(ts)) FROM arrived a WHERE a.turn < t.turn) - 3600000000 AS mark
      FROM (SELECT DISTINCT turn FROM arrived) t
    ), judged AS (
      SELECT a.*, epoch_us(ts) // 3600000000 * 3600000000 AS ws, coalesce(ws + 3600000000 <= mark, FALSE) AS late
      FROM arrived a JOIN marks USING (turn)
    )"""


@check(
    "stream_late_data",
    f"""{_LATE_SQL}
    SELECT strftime(make_timestamp(ws), '%Y-%m-%d %H:%M:%S') AS window_start,
           count(*) FILTER (WHERE NOT late) AS on_time, count(*) FILTER (WHERE late) AS late
    FROM judged GROUP BY ws""",
)
def stream_late_data(t):
    out = _late_turns(t, "late")
    return late.reconciled(t.spark, out, "1 hour")


@check("stream_late_rows", f"{_LATE_SQL} SELECT event_id, turn AS batch_id FROM judged WHERE late")
def stream_late_rows(t):
    return late.late_rows(t.spark, _late_turns(t, "late-rows")).select("event_id", "batch_id")


def _late_turns(t, label):
    low, high = t.events.agg(F.min(_micros()), F.max(_micros())).first()
    at = F.least(F.lit(_TURNS - 1), F.floor((_micros() - low) * _TURNS / (high - low + 1)))
    delay = F.when(F.col("event_id") % 29 == 0, 2).when(F.col("event_id") % 17 == 0, 1).otherwise(0)
    turn = F.least(F.lit(_TURNS - 1).cast("long"), at + delay)

    def start(stream, out):
        events = stream.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("event_time"))
        return late.split(events, out, size="1 hour", delay="1 hour")

    return _in_turns(t, label, "events", turn, _TURNS, start)


@check(
    "stream_distinct_users",
    """
    WITH per AS (SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS period, user_id FROM events
                 UNION ALL SELECT strftime(date_trunc('month', ts), '%Y-%m'), user_id FROM events)
    SELECT period, count(DISTINCT user_id) AS users, TRUE AS within FROM per GROUP BY 1""",
)
def stream_distinct_users(t):
    """Users per day by sketches over three batches, and per month by merging the days, each next to the exact number."""

    def aggregate(events):
        return distinct.sketches(windows.timed(events, "ts"), "user_id", size="1 day")

    found = _events_in_batches(t, "distinct-users", aggregate, ["window_start"])
    both, exact = [], []
    for period in ("yyyy-MM-dd", "yyyy-MM"):
        both.append(distinct.estimates(found.withColumn("period", F.date_format("window_start", period)), ["period"]))
        users = t.events.groupBy(F.date_format("ts", period).alias("period"))
        exact.append(users.agg(F.count_distinct("user_id").alias("users")))
    joined = both[0].union(both[1]).join(exact[0].union(exact[1]), "period", "full")
    close = F.abs(F.col("n_distinct") - F.col("users")) <= distinct.relative_error() * F.col("users")
    return joined.select("period", "users", F.coalesce(close, F.lit(False)).alias("within"))


# --- vitals -----------------------------------------------------------------

_REASONS_SQL = ", ".join(
    f"CASE WHEN {name} < {low} OR {name} > {high} THEN '{label}=' || CAST({name} AS VARCHAR) END"
    for name, low, high, label in rules.VITAL_RANGES
)
_VITALS_SQL = f"""
    SELECT ts, event_id, patient_id, concat_ws(', ', {_REASONS_SQL}) AS reasons
    FROM (SELECT ts, event_id, CAST(user_id AS VARCHAR) AS patient_id, 45 + event_id * 37 % 90 AS heart_rate,
                 88 + event_id % 13 AS spo2, 80 + event_id * 11 % 80 AS systolic_bp,
                 (940 + event_id % 80) / 10.0 AS temperature
          FROM events WHERE event_id % 47 <> 0)
    WHERE reasons <> ''"""


def _vital_alerts(events):
    key = F.col("event_id")
    heart = F.when(key % 47 == 0, "fast").otherwise((45 + key * 37 % 90).cast("string"))
    temperature = (940 + key % 80) / F.lit(10.0)
    line = F.concat_ws(
        ", ", F.col("user_id"), heart, 88 + key % 13, 80 + key * 11 % 80, temperature
    )
    lines = events.select("ts", "event_id", line.alias("value"))
    valid = vitals.readings(lines).filter("is_valid")
    return vitals.alerts(windows.timed(valid, "ts"))


@check("stream_vital_alerts", f"SELECT event_id, patient_id, reasons FROM ({_VITALS_SQL})")
def stream_vital_alerts(t):
    return _appended(t, "vital-alerts", _vital_alerts(t.stream("events")).select("event_id", "patient_id", "reasons"))


@check(
    "stream_running_abnormal",
    f"SELECT patient_id, count(*) AS total_abnormal FROM ({_VITALS_SQL}) GROUP BY 1",
)
def stream_running_abnormal(t):
    return _events_in_batches(t, "running-abnormal", lambda events: vitals.running_abnormal(_vital_alerts(events)), ["patient_id"])


@check(
    "stream_repeated",
    _window_sql(_VITALS_SQL, 6 * HOUR, HOUR, ["patient_id"], ["count(*) AS n"], "HAVING count(*) >= 3"),
)
def stream_repeated(t):
    def aggregate(events):
        return vitals.repeated(_vital_alerts(events), 3, "6 hours", "1 hour")

    return _events_in_batches(t, "repeated", aggregate, ["window_start", "patient_id"])


# --- bookings ---------------------------------------------------------------

_BOOKED_SQL = f"SELECT *, event_time AS ts FROM ({roles.BOOKINGS_SQL})"


def _booked(t, stream):
    return bookings.known_items(roles.booking_events(stream), roles.inventory(t))


def _timed_bookings(t, events):
    return windows.timed(_booked(t, events), "event_time")


@check(
    "stream_item_activity",
    _window_sql(
        _BOOKED_SQL,
        DAY,
        DAY // 4,
        ["item_id"],
        [
            "count(CASE WHEN action = 'BOOK' THEN 1 END) AS books",
            "count(CASE WHEN action = 'CANCEL' THEN 1 END) AS cancels",
        ],
    ),
)
def stream_item_activity(t):
    def aggregate(events):
        return bookings.item_activity(_timed_bookings(t, events), "1 day", "6 hours")

    return _events_in_batches(t, "item-activity", aggregate, ["window_start", "item_id"])


@check(
    "stream_cancel_alert",
    _window_sql(
        _BOOKED_SQL,
        HOUR,
        HOUR // 2,
        [],
        ["count(CASE WHEN action = 'CANCEL' THEN 1 END) AS cancels"],
        "HAVING cancels >= 3",
    ),
)
def stream_cancel_alert(t):
    def aggregate(events):
        return bookings.cancel_alerts(_timed_bookings(t, events), 3, "1 hour", "30 minutes")

    return _events_in_batches(t, "cancel-alert", aggregate, ["window_start"])


_BUCKET = "date_trunc('minute', event_time)"


@check("stream_booking_state", f"{roles.STATE_SQL} SELECT booking_id, item_id, seats, status FROM state")
def stream_booking_state(t):
    def start(stream, out):
        keyed.advance(t.spark, _booked(t, stream), out, _BUCKET)

    out = _in_turns(t, "booking-state", "events", _micros(), 5, start)
    return keyed.current(t.spark, out)


@check(
    "stream_occupancy",
    f"""{roles.OCCUPANCY_SQL}
    SELECT item_id, item_name, item_type, capacity, occupied, capacity - occupied AS available,
           ((occupied * 2000 + capacity) // (capacity * 2)) / 10.0 AS occupancy_pct, cancelled
    FROM report""",
)
def stream_occupancy(t):
    def start(stream, out):
        return bookings.monitor(_booked(t, stream), roles.inventory(t), out, _BUCKET)

    out = _in_turns(t, "occupancy", "events", _micros(), 3, start)
    schema = (
        "item_id string, item_name string, item_type string, capacity int, occupied long, "
        "available long, occupancy_pct double, cancelled long"
    )
    return t.spark.read.schema(schema).csv(f"{out}/occupancy", header=True)


@check(
    "stream_occupancy_keyed",
    f"""{roles.OCCUPANCY_SQL}
    SELECT item_id, item_name, item_type, capacity, occupied, capacity - occupied AS available,
           ((occupied * 2000 + capacity) // (capacity * 2)) / 10.0 AS occupancy_pct, cancelled
    FROM report""",
)
def stream_occupancy_keyed(t):
    """Seats per item kept in the state store by the changes of each of three batches."""

    def start(stream, out):
        keyed.advance_items(t.spark, _booked(t, stream), out, _BUCKET)

    out = _in_turns(t, "occupancy-keyed", "events", _micros(), 3, start)
    return keyed.occupancy(t.spark, roles.inventory(t), out)


# --- shop -------------------------------------------------------------------


@check(
    "stream_tumbling",
    _window_sql(
        """SELECT ts, p_type AS category, event_id % 5 * CAST(value AS DECIMAL(12,2)) AS amount
           FROM events JOIN part ON user_id = p_partkey WHERE event_id % 5 > 0 AND value > 0""",
        30,
        30,
        ["category"],
        [f"{_SUM} AS revenue", "count(*) AS orders"],
    ),
)
def stream_tumbling(t):
    def aggregate(events):
        orders = events.select(
            F.col("user_id").cast("string").alias("product_id"),
            (F.col("event_id") % 5).cast("int").alias("qty"),
            F.col("value").alias("price"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
        )
        return shop.category_revenue(orders, roles.shop_products(t))

    return _events_in_batches(t, "tumbling", aggregate, ["window_start", "category"])
