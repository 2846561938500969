"""Status rules of slots and bookings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the enumerated domains
SLOT_STATUSES = ["AVAILABLE", "BOOKED", "BLOCKED", "CANCELLED"]
ADMIN_STATUSES = ["AVAILABLE", "BLOCKED"]
ACTIONS = ["BOOKED", "CONFIRMED", "CANCELLED", "COMPLETED", "NO_SHOW"]
DAY_STATUSES = ["NORMAL_DAY", "HOLIDAY", "WEEKEND"]
SEND_STATUSES = ["PENDING", "SENT", "FAILED"]
GENDERS = ["male", "female"]


def flag(test: Column) -> Column:
    """1 where the test holds, else 0 (also where it is unknown)."""
    return F.when(test, F.lit(1)).otherwise(F.lit(0))


def present(number: Column) -> Column:
    """True for a number that is neither NULL nor 0."""
    return F.coalesce(number != 0, F.lit(False))


def filled(text: Column) -> Column:
    """True for text that is neither NULL nor empty."""
    return F.coalesce(text != "", F.lit(False))


def shown_status(slot_status: Column, admin_status: Column, patient_id: Column) -> Column:
    """What the slot list shows: a patient wins, then an admin block, then availability."""
    return (
        F.when(present(patient_id), F.lit("BOOKED"))
        .when(admin_status == "BLOCKED", F.lit("BLOCKED"))
        .when(slot_status == "AVAILABLE", F.lit("AVAILABLE"))
        .otherwise(F.lit("NOT_AVAILABLE"))
    )


def doctor_view(slot_status: Column, admin_status: Column, day: Column, today: Column) -> Column:
    """What a doctor sees: the admin block wins over a booking, past days are locked."""
    return (
        F.when(slot_status.isNull(), F.lit("NOT AVAILABLE"))
        .when(admin_status == "BLOCKED", F.lit("BLOCKED BY ADMIN"))
        .when(slot_status == "BOOKED", F.lit("BOOKED"))
        .when((day <= today) & (slot_status == "BLOCKED"), F.lit("LOCKED: DOCTOR BLOCKED"))
        .when(day <= today, F.concat(F.lit("LOCKED: "), slot_status))
        .otherwise(slot_status)
    )


def patient_view(shown: Column) -> Column:
    """What a patient sees: the three known states, anything else is not available."""
    return F.when(shown.isin("AVAILABLE", "BOOKED", "BLOCKED"), shown).otherwise(F.lit("NOT_AVAILABLE"))


def owned_by(shown: Column, patient_id: Column, viewer: Column) -> Column:
    """1 where the booked slot belongs to the viewing patient."""
    return flag((patient_view(shown) == "BOOKED") & (patient_id == viewer))
