"""Dimensions, facts and their current views, from staging rows.

Every dimension and fact row carries `dw_updated_at` and `dw_version`; together they order
the versions of a key. The default clock is the change time, which makes a rebuild repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotstream.functions.status import ACTIONS, flag
from slotstream.operators import latest
from slotstream.operators.joins import lookup

ORDER = ["dw_updated_at", "dw_version"]
# which correction of a fact a version is, where corrections are among them
CORRECTION = "dw_correction"
STAGING_ORDER = ["cdc_ts", "source_partition", "source_offset"]

# fixed values: columns of the dimensions, as their readers know them
DIM_COLUMNS = {
    "dim_doctor": ["doctor_id", "doctor_name", "specialty", "start_working_date"],
    "dim_patient": [
        "patient_id",
        "patient_name",
        "gender",
        "date_of_birth",
        "insurance_number",
        "email",
        "phone_number",
    ],
    "dim_slot_code": ["slot_code", "start_time", "end_time", "display_order"],
    "dim_doctor_slot": ["slot_id", "doctor_id", "slot_date", "slot_code", "slot_status"],
}

# fixed values: table: (key, columns whose current value is the latest one that is not NULL)
CURRENT_KEYS = {
    "dim_doctor": ("doctor_id", ("start_working_date",)),
    "dim_patient": ("patient_id", ("date_of_birth",)),
    "dim_slot_code": ("slot_code", ("display_order",)),
    "dim_doctor_slot": ("slot_id", ("slot_date",)),
    "fact_appointment": ("appointment_id", ("slot_date", "booked_at")),
    "fact_appointment_transaction": ("transaction_id", ("slot_date", "created_at")),
    "fact_slot_daily": ("slot_id", ("slot_date",)),
    "fact_medical_record": ("record_id", ("slot_date",)),
}


def _versioned(updated_at: Column | None) -> list[Column]:
    clock = F.col("cdc_ts") if updated_at is None else updated_at
    return [
        F.col("is_deleted"),
        clock.alias("dw_updated_at"),
        F.col("source_offset").alias("dw_version"),
    ]


def _dim(stg: DataFrame, name: str, updated_at: Column | None) -> DataFrame:
    return stg.select(*DIM_COLUMNS[name], *_versioned(updated_at))


def dim_doctor(stg: DataFrame, *, updated_at: Column | None = None) -> DataFrame:
    return _dim(stg, "dim_doctor", updated_at)


def dim_patient(stg: DataFrame, *, updated_at: Column | None = None) -> DataFrame:
    return _dim(stg, "dim_patient", updated_at)


def dim_slot_code(stg: DataFrame, *, updated_at: Column | None = None) -> DataFrame:
    return _dim(stg, "dim_slot_code", updated_at)


def dim_doctor_slot(stg: DataFrame, *, updated_at: Column | None = None) -> DataFrame:
    return _dim(stg, "dim_doctor_slot", updated_at)


def order_of(versions: DataFrame) -> list[str]:
    """The columns that order versions of a key; a correction follows the version it corrects."""
    return [*ORDER, CORRECTION] if CORRECTION in versions.columns else ORDER


def current(versions: DataFrame, table: str) -> DataFrame:
    """The current view of a dimension or fact table."""
    key, nullable = CURRENT_KEYS[table]
    return latest.current(versions, [key], order_of(versions), nullable=nullable)


def slot_attributes(stg_slots: DataFrame) -> DataFrame:
    """Doctor, date and code of each slot as last known, one row per slot.

    A delete may carry the key alone, so it does not hide what was known before it.
    """
    known = stg_slots.filter(F.col("is_deleted") == 0).select(
        "slot_id", "doctor_id", "slot_date", "slot_code", *STAGING_ORDER
    )
    newest = latest.replace_latest(known, ["slot_id"], STAGING_ORDER)
    return newest.select("slot_id", "doctor_id", "slot_date", "slot_code")


def _with_slot(stg: DataFrame, slots: DataFrame, missing: str | None) -> DataFrame:
    """Adds the slot's columns to every row; `missing` stands for text of unknown slots.

    `slots` has one row per slot; some slots may be booked or logged far more often than others.
    """
    joined = lookup(stg, slots.select("slot_id", "doctor_id", "slot_date", "slot_code"), ["slot_id"])
    if missing is None:
        return joined
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(missing)) for c in ("doctor_id", "slot_code")}
    )


def fact_appointment(
    stg: DataFrame, slots: DataFrame, *, missing: str | None = "", updated_at: Column | None = None
) -> DataFrame:
    """Bookings with their slot; `slots` as `slot_attributes` gives them."""
    return _with_slot(stg, slots, missing).select(
        "appointment_id",
        "booking_ref",
        "slot_id",
        "doctor_id",
        "patient_id",
        "slot_date",
        "slot_code",
        "booked_at",
        F.lit(1).alias("appointment_count"),
        *_versioned(updated_at),
    )


def action_flags(action: Column) -> list[Column]:
    """One additive 0/1 measure per booking action."""
    return [flag(action == name).alias(f"is_{name.lower()}_event") for name in ACTIONS]


def fact_transaction(
    stg: DataFrame, slots: DataFrame, *, missing: str | None = "", updated_at: Column | None = None
) -> DataFrame:
    """Booking log entries with their slot and action flags."""
    return _with_slot(stg, slots, missing).select(
        "transaction_id",
        "slot_id",
        "doctor_id",
        "patient_id",
        "slot_date",
        "slot_code",
        "action",
        "created_at",
        F.lit(1).alias("event_count"),
        *action_flags(F.col("action")),
        *_versioned(updated_at),
    )


def fact_slot_daily(stg: DataFrame, *, updated_at: Column | None = None) -> DataFrame:
    """Slots with one additive 0/1 measure per status."""
    state = F.col("slot_status")
    return stg.select(
        "slot_id",
        "doctor_id",
        "slot_date",
        "slot_code",
        "slot_status",
        F.lit(1).alias("slot_count"),
        flag(state == "AVAILABLE").alias("is_available"),
        flag(state == "BOOKED").alias("is_booked"),
        flag(state == "BLOCKED").alias("is_blocked"),
        flag(state == "CANCELLED").alias("is_cancelled"),
        *_versioned(updated_at),
    )


def fact_record(
    stg: DataFrame, slots: DataFrame, *, missing: str | None = "", updated_at: Column | None = None
) -> DataFrame:
    """Medical record versions with their slot."""
    return _with_slot(stg, slots, missing).select(
        "record_id",
        "slot_id",
        "doctor_id",
        "patient_id",
        "slot_date",
        "slot_code",
        "version_number",
        "diagnosis_note",
        "prescription_note",
        F.lit(1).alias("record_count"),
        *_versioned(updated_at),
    )


def refresh_slot_columns(
    fact: DataFrame, slots: DataFrame, *, missing: str | None = ""
) -> DataFrame:
    """Facts with their slot columns looked up again.

    Puts right facts that were written before their slot arrived or changed.
    """
    bare = fact.drop("doctor_id", "slot_date", "slot_code")
    return _with_slot(bare, slots, missing).select(*fact.columns)
