"""Booking state: what a sequence of BOOK and CANCEL leaves behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import rules
from millrace.operators import windows


def known_actions(events: DataFrame) -> DataFrame:
    """Events that book or cancel; any other action, or none, is no booking event."""
    return events.filter(F.col("action").isin(rules.BOOK, rules.CANCEL))


def booking_effects(events: DataFrame, bucket: str) -> DataFrame:
    """What each booking's events do, as one row per booking.

    Events carry ``booking_id, item_id, seats, action`` and the order columns
    ``event_time, event_id``. A BOOK opens a booking unless the one before it
    was a BOOK too, and a CANCEL ends it. Whether the very first BOOK opens
    anything depends on the state the events meet, so it is kept apart:

    * ``first_*``  - the BOOK that comes before any CANCEL, if there is one;
    * ``open_*``   - the last BOOK that follows a CANCEL, if there is one;
    * ``last_action``.
    """
    track = windows.Track(
        keys=["booking_id"], order="event_time", bucket=bucket, tiebreak=["event_id"]
    )
    chained = windows.with_previous(events, track, "action", "previous_action")
    position = F.struct("event_time", "event_id")
    choice = F.struct("item_id", "seats")
    is_book = F.col("action") == rules.BOOK
    reopens = is_book & (F.col("previous_action") == rules.CANCEL)
    leads = is_book & F.col("previous_action").isNull()
    return chained.groupBy("booking_id").agg(
        F.max_by(F.when(leads, choice), F.when(leads, position)).alias("first"),
        F.max_by(F.when(reopens, choice), F.when(reopens, position)).alias("open"),
        F.max_by("action", position).alias("last_action"),
    )


def apply_effects(state: DataFrame | None, effects: DataFrame) -> DataFrame:
    """Bring a booking state forward by one set of effects.

    Both sides have one row per booking, so the join has no hot keys.
    """
    if state is None:
        joined = effects.select(
            "*",
            F.lit(None).cast("string").alias("old_item"),
            F.lit(None).cast("int").alias("old_seats"),
            F.lit(None).cast("string").alias("old_status"),
        )
    else:
        old = state.select(
            "booking_id",
            F.col("item_id").alias("old_item"),
            F.col("seats").alias("old_seats"),
            F.col("status").alias("old_status"),
        )
        joined = old.join(effects, "booking_id", "full")

    was_booked = F.coalesce(F.col("old_status") == rules.BOOKED, F.lit(False))
    # The latest BOOK that took hold: one after a CANCEL, else the leading one
    # unless the booking was already open, else whatever the state holds.
    leading = ~was_booked & F.col("first").isNotNull()

    def latest(field: str, old: str) -> Column:
        return (
            F.when(F.col("open").isNotNull(), F.col(f"open.{field}"))
            .when(leading, F.col(f"first.{field}"))
            .otherwise(F.col(old))
        )

    status = (
        F.when(F.col("last_action").isNull(), F.col("old_status"))
        .when(F.col("last_action") == rules.BOOK, F.lit(rules.BOOKED))
        .otherwise(F.lit(rules.CANCELLED))
    )
    moved = joined.select(
        "booking_id",
        latest("item_id", "old_item").alias("item_id"),
        latest("seats", "old_seats").alias("seats"),
        status.alias("status"),
    )
    # CANCEL without any booking leaves no state.
    return moved.filter(F.col("item_id").isNotNull())


def booking_state(events: DataFrame, bucket: str) -> DataFrame:
    """Final state per booking: item, seats, BOOKED or CANCELLED."""
    return apply_effects(None, booking_effects(events, bucket))
