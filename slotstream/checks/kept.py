"""Changes to tables that are kept in parts: the same rows as the operators on whole tables give."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.checks.base import ORACLES, query
from slotstream.plans import changes
from slotstream.session import run_dir
from slotstream.testdata import view


@query("kept_delete_keys", ORACLES["delete_keys"])
def kept_delete_keys(spark: SparkSession, sf: str) -> DataFrame:
    table = changes.Kept.create(view(spark, sf, "v_appointment"), run_dir(spark, "kept"), ["slot_id"], parts=8)
    table.delete(view(spark, sf, "v_txn"))
    return table.read()


@query("kept_update_rows", ORACLES["update_rows"])
def kept_update_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Patients with a booking renamed, those of even ids first and the others after them."""
    stamp = F.lit("2020-01-01 00:00:00").cast("timestamp")
    patients = view(spark, sf, "v_patient").withColumn("updated_at", stamp)
    table = changes.Kept.create(patients, run_dir(spark, "kept"), ["patient_id"], parts=8)
    named = (
        view(spark, sf, "v_appointment")
        .groupBy("patient_id")
        .agg(F.concat(F.lit("Renamed "), F.count(F.lit(1)).cast("string")).alias("patient_name"))
    )
    now = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp")
    for rest in (0, 1):
        table.update(named.filter(F.col("patient_id") % 2 == rest), ["patient_name", "address"], now=now)
    return table.read()


def changed_days(spark: SparkSession, sf: str) -> dict[str, changes.Kept]:
    """Sundays become holidays, then the holidays become ordinary days."""
    keys = {"v_calendar": "date", "v_slot": "slot_date", "v_appointment": "slot_id", "v_txn": "slot_id"}
    kept = {
        v: changes.Kept.create(view(spark, sf, v), run_dir(spark, "kept"), [key], parts=8) for v, key in keys.items()
    }
    for before, after in (("WEEKEND", "HOLIDAY"), ("HOLIDAY", "NORMAL_DAY")):
        days = view(spark, sf, "v_calendar").filter(F.col("status") == before)
        changes.change_days(days.withColumn("status", F.lit(after)), *kept.values())
    return kept


@query("kept_days_slots", ORACLES["holiday_cascade_slots"])
def kept_days_slots(spark: SparkSession, sf: str) -> DataFrame:
    return changed_days(spark, sf)["v_slot"].read()


@query("kept_days_appointments", ORACLES["holiday_cascade_appointments"])
def kept_days_appointments(spark: SparkSession, sf: str) -> DataFrame:
    return changed_days(spark, sf)["v_appointment"].read()


@query("kept_slot_updates", ORACLES["slot_updates_applied"])
def kept_slot_updates(spark: SparkSession, sf: str) -> DataFrame:
    table = changes.Kept.create(view(spark, sf, "v_slot"), run_dir(spark, "kept"), ["slot_date"], parts=8)
    changes.update_slots(table, *[view(spark, sf, v) for v in ("v_update", "v_calendar", "v_appointment")])
    return table.read()
