"""Notification texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: event types, subjects and wording of the messages
CONFIRMATION, CANCELLATION = "BOOKING_CONFIRMATION", "BOOKING_CANCELLATION"
EVENT_TYPES = {"BOOKED": CONFIRMATION, "CANCELLED": CANCELLATION}
SUBJECTS = {CONFIRMATION: "Booking Confirmation", CANCELLATION: "Booking Cancellation"}
DEFAULT_SUBJECT = "Appointment Notification"
BOOKED_LINE = "Your appointment has been booked successfully."
CANCELLED_LINE = "Your appointment has been cancelled."
BODY = "Dear %s,\n\n%s\n\nDoctor: %s\nSpecialty: %s\nDate: %s\nSlot: %s\n\nThank you.\n"


def _translated(value: Column, table: dict[str, str]) -> Column:
    """The table's text for a value; NULL for values the table lacks."""
    return F.coalesce(*[F.when(value == name, F.lit(text)) for name, text in table.items()])


def event_type(action: Column) -> Column:
    """The notification a booking action causes; NULL for other actions."""
    return _translated(action, EVENT_TYPES)


def subject(kind: Column) -> Column:
    return F.coalesce(_translated(kind, SUBJECTS), F.lit(DEFAULT_SUBJECT))


def body(
    kind: Column,
    patient_name: Column,
    slot_date: Column,
    slot_code: Column,
    doctor_name: Column,
    specialty: Column,
) -> Column:
    line = F.when(kind == CONFIRMATION, F.lit(BOOKED_LINE)).otherwise(F.lit(CANCELLED_LINE))
    return F.format_string(
        BODY, patient_name, line, doctor_name, specialty, slot_date.cast("string"), slot_code
    )
