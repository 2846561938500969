"""Slot lists and single-slot changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotstream.functions import status, text
from slotstream.operators import latest, mutations, schedule
from slotstream.operators.joins import lookup
from slotstream.session import materialise

PLACE = ["doctor_id", "slot_date", "slot_code"]

# holidays, as rows of one date, that are sent to all tasks; more of them are joined
MOST_BROADCAST = 100_000

# fixed values: outcomes of a slot change
HOLIDAY = "Cannot modify slots. This date is blocked by Admin."
BOOKED = "Cannot change status of a booked slot"
UPDATED = "Slot updated"
CREATED = "Slot created"


def availability(wanted: DataFrame, slots: DataFrame, appointments: DataFrame) -> DataFrame:
    """All 16 codes of each wanted `(doctor_id, slot_date)` with the status to show.

    A code without a slot shows as not available. Should a place hold several slots, the
    one with the greatest id counts. Known slots are gathered to one row per day (16 codes at
    most), which meets the wanted days; codes are spread out after that join.
    """
    booked = slots.select("slot_id", *PLACE, "slot_status", "admin_status").join(
        appointments.select("slot_id", "patient_id"), "slot_id", "left"
    )
    day = ["doctor_id", "slot_date"]
    codes = schedule.slot_codes()
    known = latest.replace_latest(
        booked.filter(F.array_contains(codes, F.col("slot_code"))), PLACE, ["slot_id"]
    )
    rest = [c for c in known.columns if c not in PLACE]
    entry = F.struct("slot_code", F.struct(*rest).alias("slot"))
    known = known.groupBy(*day).agg(F.map_from_entries(F.collect_list(entry)).alias("_slots"))
    days = lookup(wanted.select(*day).distinct(), known, day)
    grid = days.select(*day, "_slots", F.explode(codes).alias("slot_code"))
    grid = grid.withColumn("_slot", F.try_element_at("_slots", F.col("slot_code")))
    grid = grid.select(*PLACE, "_slot.*")
    shown = status.shown_status(F.col("slot_status"), F.col("admin_status"), F.col("patient_id"))
    return grid.select(
        *PLACE,
        "slot_id",
        shown.alias("slot_status"),
        F.coalesce("admin_status", F.lit("AVAILABLE")).alias("admin_status"),
        "patient_id",
    )


def patient_in_slot(
    slots: DataFrame,
    appointments: DataFrame,
    place: tuple[str, object, str] | None = None,
) -> DataFrame:
    """Patients of booked slots the administrator has not blocked, at one place or at all."""
    rows = slots.filter((F.col("slot_status") == "BOOKED") & (F.col("admin_status") == "AVAILABLE"))
    if place is not None:
        for name, value in zip(PLACE, place):
            rows = rows.filter(F.col(name) == F.lit(value))
    return rows.select("slot_id", *PLACE).join(
        appointments.select("slot_id", "patient_id"), "slot_id"
    ).select(*PLACE, "patient_id")


def slot_id_at(slots: DataFrame, doctor_id: str, day: object, slot_code: str) -> DataFrame:
    """The slot at a place."""
    return slots.filter(
        (F.col("doctor_id") == doctor_id) & (F.col("slot_date") == F.lit(day)) & (F.col("slot_code") == slot_code)
    ).select("slot_id")


def judge_updates(
    slots: DataFrame, updates: DataFrame, days: DataFrame, appointments: DataFrame
) -> DataFrame:
    """Verdict of each update `(update_id, doctor_id, slot_date, slot_code, status, requested_at)`.

    Updates count in the order `(requested_at, update_id)`. Holidays reject any update, a
    booked slot any status but BOOKED. At a place without a slot the first update creates it.
    """
    known = slots.select("slot_id", *PLACE).join(
        latest.unique_keys(appointments, ["slot_id"]).withColumn("_taken", F.lit(True)), "slot_id", "left"
    )
    known = latest.replace_latest(known, PLACE, ["slot_id"])
    judged = lookup(updates, known, PLACE)
    # who is first matters only where there is no slot yet
    firsts = (
        judged.filter(F.col("slot_id").isNull())
        .groupBy(*PLACE)
        .agg(F.min_by("update_id", F.struct("requested_at", "update_id")).alias("_first"))
    )
    # joined on the update as well, which is unique, so that no place gathers all its updates
    judged = judged.join(
        firsts.select(F.col("_first").alias("update_id"), F.lit(True).alias("_first")),
        "update_id",
        "left",
    )
    holidays = latest.unique_keys(
        days.filter(F.col("status") == "HOLIDAY").select(F.col("date").alias("slot_date")), ["slot_date"]
    ).withColumn("_holiday", F.lit(True))
    if holidays.count() <= MOST_BROADCAST:
        judged = judged.join(F.broadcast(holidays), "slot_date", "left")
    else:
        judged = lookup(judged, holidays, ["slot_date"])
    exists = F.col("slot_id").isNotNull()
    verdict = (
        F.when(F.col("_holiday"), F.lit(HOLIDAY))
        .when(exists & F.col("_taken") & (F.col("status") != "BOOKED"), F.lit(BOOKED))
        .when(exists, F.lit(UPDATED))
        .when(F.col("_first"), F.lit(CREATED))
        .otherwise(F.lit(UPDATED))
    )
    composed = text.slot_key(F.col("slot_date"), F.col("doctor_id"), F.col("slot_code"))
    return (
        judged.withColumn("message", verdict)
        .withColumn("success", F.col("message").isin(UPDATED, CREATED))
        .withColumn("slot_id", F.when(F.col("success"), F.coalesce("slot_id", composed)))
        .select(*updates.columns, "slot_id", "success", "message")
    )


def apply_updates(
    slots: DataFrame, updates: DataFrame, days: DataFrame, appointments: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """New slots and the verdicts. The last accepted update of a slot decides its status."""
    verdicts = materialise(judge_updates(slots, updates, days, appointments))
    accepted = verdicts.filter("success").select(
        "slot_id", *PLACE, F.col("status").alias("slot_status"), "requested_at", "update_id"
    )
    final = latest.replace_latest(accepted, ["slot_id"], ["requested_at", "update_id"]).select(
        "slot_id", *PLACE, "slot_status", F.lit("AVAILABLE").alias("admin_status")
    )
    guard = {c: F.col(f"cur.{c}") for c in (*PLACE, "admin_status")}
    return mutations.upsert(slots, final, ["slot_id"], guard=guard), verdicts
