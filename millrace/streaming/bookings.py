"""Booking monitor: activity per item, booking state, occupancy reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace import schemas
from millrace.functions import rules
from millrace.operators import joins
from millrace.operators.layout import reused
from millrace.operators.quality import LineSpec, parse_delimited, valid_only
from millrace.plans import bookings, reports
from millrace.sinks.writers import write_report
from millrace.streaming.tables import carried_state
from millrace.streaming.windows import windowed

BOOKING_LINE = LineSpec(
    fields=(
        ("booking_id", "string"),
        ("booking_type", "string"),
        ("item_id", "string"),
        ("action", "string"),
        ("seats", "int"),
    ),
    required=("booking_id",),
    positive=("seats",),
    upper=("booking_type", "action"),
    allowed={"action": (rules.BOOK, rules.CANCEL)},
)


def parse(lines: DataFrame) -> DataFrame:
    return valid_only(parse_delimited(lines, BOOKING_LINE))


def known_items(events: DataFrame, inventory: DataFrame) -> DataFrame:
    """Events of items in the inventory (an inventory has unique items)."""
    return joins.look_up(events, inventory.select("item_id"), "item_id", "left_semi")


def item_activity(events: DataFrame, size: str = rules.WINDOW_SIZE, slide: str = rules.WINDOW_SLIDE) -> DataFrame:
    measures = [
        F.count_if(F.col("action") == rules.BOOK).alias("books"),
        F.count_if(F.col("action") == rules.CANCEL).alias("cancels"),
    ]
    return windowed(events, measures, ["item_id"], size, slide)


def cancel_alerts(
    events: DataFrame,
    limit: int = rules.CANCEL_LIMIT,
    size: str = rules.WINDOW_SIZE,
    slide: str = rules.WINDOW_SLIDE,
) -> DataFrame:
    """Windows with at least ``limit`` cancellations over all items."""
    cancels = F.count_if(F.col("action") == rules.CANCEL).alias("cancels")
    return windowed(events, [cancels], size=size, slide=slide).filter(F.col("cancels") >= limit)


def state_step(bucket: str):
    """Bring the booking state forward by one micro-batch.

    Within a batch events count in the order (event time, event id); batches
    count in the order of arrival.
    """

    def step(before: DataFrame | None, batch: DataFrame) -> DataFrame:
        moved = bookings.apply_effects(before, bookings.booking_effects(batch, bucket))
        return moved.select("booking_id", "item_id", F.col("seats").cast("int"), "status")

    return step


def state_stream(events: DataFrame, out: str, bucket: str) -> DataStreamWriter:
    """Keep the state per booking below ``out``."""
    return carried_state(events, out, schemas.BOOKING_STATE, state_step(bucket))


def monitor(events: DataFrame, inventory: DataFrame, out: str, bucket: str) -> DataStreamWriter:
    """Booking state plus occupancy reports refreshed with every batch."""

    def refresh(state: DataFrame, batch_id: int) -> None:
        with reused(reports.occupancy(inventory, state)) as report:
            write_report(report, f"{out}/occupancy")
            write_report(reports.occupancy_by_type(report), f"{out}/occupancy_by_type")
            write_report(reports.overbooked(report), f"{out}/overbooked")

    return carried_state(events, out, schemas.BOOKING_STATE, state_step(bucket), after=refresh)
