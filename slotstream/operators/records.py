"""Versioned medical records: latest versions, histories, new versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotstream.operators import latest
from slotstream.operators.joins import lookup
from slotstream.operators.numbering import number_rows

VERSION_ORDER = ["version_number", "record_id"]
KEYS = ("slot_id", "patient_id")


def latest_per_slot(records: DataFrame) -> DataFrame:
    """The highest version of each slot; equal versions by record id."""
    return latest.replace_latest(records, ["slot_id"], VERSION_ORDER)


def latest_detail(
    slots: DataFrame,
    appointments: DataFrame,
    patients: DataFrame,
    records: DataFrame,
    slot_id: str | None = None,
) -> DataFrame:
    """Booked slots with patient and latest record version, if there is one.

    Records are reduced to one row per slot before the join, so a slot with a long history
    costs the join no more than any other.
    """
    if slot_id is not None:
        slots = slots.filter(F.col("slot_id") == slot_id)
        records = records.filter(F.col("slot_id") == slot_id)
    booked = (
        slots.select("slot_id", "slot_date")
        .join(appointments.select("slot_id", "patient_id"), "slot_id")
        .join(patients.select("patient_id", "patient_name"), "patient_id")
    )
    newest = latest_per_slot(records).drop("patient_id")
    return booked.join(newest, "slot_id", "left")


def by_doctor(
    records: DataFrame, slots: DataFrame, patients: DataFrame, doctor_id: str | None = None
) -> DataFrame:
    """Latest record version of each slot, of one doctor or of all."""
    if doctor_id is not None:
        slots = slots.filter(F.col("doctor_id") == doctor_id)
    # notes stay behind until the latest records are known
    narrow = records.select("record_id", "slot_id", "patient_id", "version_number")
    named = lookup(narrow, patients.select("patient_id", "patient_name"), ["patient_id"], "inner")
    newest = latest_per_slot(named).join(
        slots.select("slot_id", "doctor_id", "slot_date", "slot_code"), "slot_id"
    )
    wide = records.select(
        "record_id", "slot_id", "version_number", "diagnosis_note", "prescription_note", "created_at"
    )
    joined = newest.join(wide, ["record_id", "slot_id", "version_number"])
    return joined.select(
        "doctor_id",
        "record_id",
        "slot_id",
        "patient_id",
        "patient_name",
        "version_number",
        "diagnosis_note",
        "prescription_note",
        "slot_date",
        "slot_code",
        "created_at",
    )


def by_slot(
    records: DataFrame, slots: DataFrame, patients: DataFrame, slot_id: str | None = None
) -> DataFrame:
    """All record versions, of one slot or of all, newest first within the slot."""
    if slot_id is not None:
        slots = slots.filter(F.col("slot_id") == slot_id)
        records = records.filter(F.col("slot_id") == slot_id)
    placed = lookup(records, slots.select("slot_id", "slot_date", "slot_code"), ["slot_id"], "inner")
    joined = lookup(placed, patients.select("patient_id", "patient_name"), ["patient_id"], "inner")
    return joined.orderBy("slot_id", F.desc_nulls_first("version_number"), "record_id")


def by_insurance(
    records: DataFrame,
    slots: DataFrame,
    patients: DataFrame,
    doctors: DataFrame,
    insurance_number: str | None = None,
) -> DataFrame:
    """Latest record version per patient and slot, by doctor; one insurance number or all."""
    insured = patients.filter(F.col("insurance_number").isNotNull())
    if insurance_number is not None:
        insured = insured.filter(F.col("insurance_number") == insurance_number)
    mine = lookup(
        records.select("record_id", "slot_id", "patient_id", "version_number"),
        insured.select("patient_id", "insurance_number"),
        ["patient_id"],
        "inner",
    )
    newest = latest.replace_latest(mine, ["patient_id", "slot_id"], VERSION_ORDER)
    joined = newest.join(
        slots.select("slot_id", "doctor_id", "slot_date", "slot_code"), "slot_id"
    ).join(doctors.select("doctor_id", "doctor_name"), "doctor_id")
    return joined.select(
        "insurance_number",
        "doctor_id",
        "doctor_name",
        F.col("record_id").alias("medical_record_id"),
        "slot_id",
        F.col("slot_date").alias("date"),
        "slot_code",
        "version_number",
    ).orderBy("doctor_id", "slot_id", "insurance_number")


def next_version(records: DataFrame, keys: list[str] | tuple[str, ...] = KEYS) -> DataFrame:
    """The version number the next record of each key gets; none or 0 so far gives 1."""
    highest = F.coalesce(F.max("version_number"), F.lit(0))
    return records.groupBy(*keys).agg((highest + F.lit(1)).cast("int").alias("next_version"))


def append_versions(
    current: DataFrame,
    new: DataFrame,
    order: list[str],
    *,
    keys: tuple[str, ...] = KEYS,
) -> DataFrame:
    """New records with the version numbers that follow the current ones of their key.

    Several new records of one key are numbered by `order`, which must be total within the key.
    Only keys and order are numbered; notes and the like are moved once, to meet their number.
    The highest current version is looked up per distinct key, so the join sees each key once on
    either side.
    """
    narrow = list(dict.fromkeys([*keys, *order]))
    numbered = number_rows(new.select(*narrow), order, "_place", keys=list(keys))
    wanted = latest.unique_keys(numbered, list(keys))
    starts = wanted.join(next_version(current, keys), list(keys), "left").select(
        *keys, F.coalesce("next_version", F.lit(1)).alias("_first")
    )
    joined = lookup(numbered, starts, list(keys), "inner")
    version = (F.col("_first") + F.col("_place") - F.lit(1)).cast("int")
    versions = joined.select(*narrow, version.alias("version_number"))
    if set(narrow) == set(new.columns):
        return versions.select(*new.columns, "version_number")
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"v.{c}")) for c in narrow]
    return new.alias("n").join(versions.alias("v"), same).select("n.*", "v.version_number")
