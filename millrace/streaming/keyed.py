"""Booking state kept in the state store: a micro-batch touches the bookings that it names and no others.

Two queries in a row. The first brings each micro-batch down to one effect per
booking with ordinary distributed windows and aggregates, so a booking with
very many events in a batch meets no single task, and writes the effects under
the number of their batch. The second reads effects as they are written and
applies them to a value per booking in the state store. It gives the bookings
that changed, and writes nothing for the others. A third one adds what changed
to the seats and cancellations of the items, so a report over all items reads
one row an item and no booking. Each query runs when the one before is done.

A retried batch of the first query writes its effects again under the same
number; the state holds the number of the last effect that it took and passes
over what it has, so every batch counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

from millrace import schemas
from millrace.functions import rules
from millrace.plans import bookings, reports
from millrace.streaming.tables import BATCH, batch_report, changes_table, drain, read_latest

_CHOICE = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("seats", T.IntegerType())])
EFFECTS = T.StructType(
    [
        T.StructField("booking_id", T.StringType()),
        T.StructField("first", _CHOICE),
        T.StructField("open", _CHOICE),
        T.StructField("last_action", T.StringType()),
    ]
)
# A booking as it is, and as it was before the micro-batch.
_WAS = [T.StructField(f"was_{f.name}", f.dataType) for f in schemas.BOOKING_STATE.fields[1:]]
CHANGES = T.StructType([*schemas.BOOKING_STATE.fields, *_WAS])
ITEMS = T.StructType([T.StructField(name, kind) for name, kind in (("item_id", T.StringType()), ("occupied", T.LongType()), ("cancelled", T.LongType()))])
_HELD = "item_id string, seats int, status string, applied long"


def effects(events: DataFrame, out: str, bucket: str) -> DataStreamWriter:
    """Write one effect per booking of every micro-batch."""

    def report(batch: DataFrame) -> DataFrame:
        found = bookings.booking_effects(batch, bucket)
        return found.select(*(F.col(f.name).cast(f.dataType) for f in EFFECTS))

    return batch_report(events, f"{out}/effects", report)


def advanced(held: tuple | None, effect: Row) -> tuple | None:
    """(item, seats, status, applied) after one effect; a CANCEL without a booking leaves nothing."""
    item, seats, status, applied = held or (None, None, None, -1)
    if effect[BATCH] <= applied:
        return held
    choice = effect.open
    if choice is None and status != rules.BOOKED:
        choice = effect.first
    if choice is not None:
        item, seats = choice["item_id"], choice["seats"]
    if item is None:
        return None
    return item, seats, rules.BOOKED if effect.last_action == rules.BOOK else rules.CANCELLED, effect[BATCH]


class BookingState(StatefulProcessor):
    """One value per booking. A key's rows are as many as the micro-batches that it reads at once."""

    def init(self, handle) -> None:
        self.held = handle.getValueState("booking", _HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = tuple(self.held.get()) if self.held.exists() else None
        after = before
        for effect in sorted(rows, key=lambda row: row[BATCH]):
            after = advanced(after, effect)
        if after is not None and after != before:
            self.held.update(after)
            was = before or (None, None, None)
            yield Row(
                booking_id=key[0], item_id=after[0], seats=after[1], status=after[2], was_item_id=was[0], was_seats=was[1], was_status=was[2]
            )

    def close(self) -> None:
        pass


def state_changes(spark: SparkSession, out: str, files_per_batch: int | None = None) -> DataFrame:
    """CHANGES: bookings as they change, from the effects below ``out``."""
    reader = spark.readStream.schema(T.StructType([*EFFECTS.fields, T.StructField(BATCH, T.LongType())]))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    found = reader.parquet(f"{out}/effects/data")
    return found.groupBy("booking_id").transformWithState(
        statefulProcessor=BookingState(), outputStructType=CHANGES, outputMode="update", timeMode="none"
    )


def item_totals(spark: SparkSession, out: str) -> DataFrame:
    """ITEMS as they change, from the changes of bookings below ``out``; a batch touches the items of its bookings."""
    changes = spark.readStream.schema(T.StructType([*CHANGES.fields, T.StructField(BATCH, T.LongType())])).parquet(f"{out}/state/data")

    def side(prefix: str, sign: int):
        seats, status = F.col(f"{prefix}seats").cast("long"), F.col(f"{prefix}status")
        return F.struct(
            F.col(f"{prefix}item_id").alias("item_id"),
            F.when(status == rules.BOOKED, sign * seats).otherwise(0).cast("long").alias("seats"),
            F.when(status == rules.CANCELLED, sign).otherwise(0).cast("long").alias("cancels"),
        )

    sides = changes.select(F.inline(F.array(side("", 1), side("was_", -1)))).filter("item_id IS NOT NULL AND (seats <> 0 OR cancels <> 0)")
    return sides.groupBy("item_id").agg(F.sum("seats").alias("occupied"), F.sum("cancels").alias("cancelled"))


def steps(spark: SparkSession, events: DataFrame, out: str, bucket: str) -> list[Callable[[], DataStreamWriter]]:
    """The first two queries in order; the second needs what the first has written."""
    return [lambda: effects(events, out, bucket), lambda: changes_table(state_changes(spark, out), f"{out}/state")]


def advance_items(spark: SparkSession, events: DataFrame, out: str, bucket: str) -> None:
    """Take in everything that has arrived, totals of items included."""
    advance(spark, events, out, bucket)
    drain(changes_table(item_totals(spark, out), f"{out}/items"), closing_batch=False)


def occupancy(spark: SparkSession, inventory: DataFrame, out: str) -> DataFrame:
    """The occupancy report from the totals of items; no booking is read."""
    return reports.occupancy_of(inventory, read_latest(spark, f"{out}/items", ITEMS, ["item_id"]))


def advance(spark: SparkSession, events: DataFrame, out: str, bucket: str) -> None:
    """Take in everything that has arrived."""
    for step in steps(spark, events, out, bucket):
        drain(step(), closing_batch=False)


def current(spark: SparkSession, out: str) -> DataFrame:
    """The state of every booking so far."""
    return read_latest(spark, f"{out}/state", schemas.BOOKING_STATE, ["booking_id"])
