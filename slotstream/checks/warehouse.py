"""Queries on dimensions, facts and current views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.checks.base import query
from slotstream.checks.change_data import SLOT, slot_messages
from slotstream.operators import cdc, latest, staging, warehouse
from slotstream.plans import warehouse as plan
from slotstream.sources.registry import TABLES
from slotstream.testdata import messages, view, with_views



def ingested() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def staged(spark: SparkSession, sf: str, name: str, table: str, renames: dict[str, str]) -> DataFrame:
    """A change log view through messages and decoding into staging rows."""
    cfg = TABLES[table]
    changes = view(spark, sf, name).withColumnsRenamed(renames)
    raw = messages(changes, cfg, cfg.topic())
    return staging.to_staging(cdc.decode(raw, cfg, ingested_at=ingested()), cfg, batch_id=0)


def staged_version(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A view that already has staging columns."""
    return view(spark, sf, name).withColumns(
        {
            "is_deleted": F.when(F.col("op") == "d", 1).otherwise(0),
            "source_partition": F.lit(0),
        }
    )


def slot_staging(spark: SparkSession, sf: str) -> DataFrame:
    raw = slot_messages(spark, sf)
    return staging.to_staging(cdc.decode(raw, SLOT, ingested_at=ingested()), SLOT, batch_id=0)


def _current_sql(view_name: str, key: str, columns: dict[str, str], nullable: dict[str, str]) -> str:
    """Latest row per key by second and offset; nullable columns keep the latest non-NULL value."""
    plain = ", ".join(f"arg_max({{'v': {e}}}, o)['v'] AS {c}" for c, e in columns.items())
    loose = "".join(f", arg_max({e}, o) AS {c}" for c, e in nullable.items())
    return (
        with_views(view_name)
        + f""", versions AS (SELECT *, CASE WHEN op = 'd' THEN 1 ELSE 0 END AS del,
  date_trunc('second', ts) AS t, (date_trunc('second', ts), kafka_offset) AS o FROM {view_name})
SELECT {key}, {plain}{loose}, arg_max(del, o) AS is_deleted, max(t) AS latest_dw_updated_at
FROM versions GROUP BY {key} HAVING arg_max(del, o) = 0"""
    )


@query(
    "dim_current_slot",
    _current_sql(
        "v_change",
        "slot_id",
        {c: c for c in ("doctor_id", "slot_code", "slot_status")},
        {"slot_date": "DATE '1970-01-01' + CAST(slot_date_days AS INT)"},
    ),
)
def dim_current_slot(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.current(warehouse.dim_doctor_slot(slot_staging(spark, sf)), "dim_doctor_slot")


@query(
    "dim_current_doctor",
    _current_sql(
        "v_doctor_change",
        "doctor_id",
        {c: c for c in ("doctor_name", "specialty")},
        {"start_working_date": "DATE '1970-01-01' + CAST(start_days AS INT)"},
    ),
)
def dim_current_doctor(spark: SparkSession, sf: str) -> DataFrame:
    stg = staged(spark, sf, "v_doctor_change", "doctor", {"start_days": "start_working_date"})
    return warehouse.current(warehouse.dim_doctor(stg), "dim_doctor")


@query(
    "dim_current_patient",
    _current_sql(
        "v_patient_change",
        "patient_id",
        {c: c for c in ("patient_name", "gender", "insurance_number", "email", "phone_number")},
        {"date_of_birth": "DATE '1970-01-01' + CAST(birth_days AS INT)"},
    ),
)
def dim_current_patient(spark: SparkSession, sf: str) -> DataFrame:
    cfg = TABLES["patient"]
    changes = (
        view(spark, sf, "v_patient_change")
        .withColumnRenamed("birth_days", "date_of_birth")
        .withColumns({c: F.unix_micros("ts") for c in ("created_at", "updated_at")})
    )
    raw = messages(changes, cfg, cfg.topic())
    stg = staging.to_staging(cdc.decode(raw, cfg, ingested_at=ingested()), cfg, batch_id=0)
    return warehouse.current(warehouse.dim_patient(stg), "dim_patient")


@query(
    "dim_current_slot_code",
    _current_sql(
        "v_slot_code_change",
        "slot_code",
        {c: c for c in ("start_time", "end_time")},
        {"display_order": "display_order"},
    ),
)
def dim_current_slot_code(spark: SparkSession, sf: str) -> DataFrame:
    stg = staged(spark, sf, "v_slot_code_change", "slot_code_template", {})
    return warehouse.current(warehouse.dim_slot_code(stg), "dim_slot_code")


@query(
    "staging_rows",
    with_views("v_patient_change")
    + """SELECT CAST(patient_id AS INT) AS patient_id, patient_name, address, phone_number, insurance_number,
  DATE '1970-01-01' + CAST(birth_days AS INT) AS date_of_birth, gender, email,
  date_trunc('second', ts) AS created_at, date_trunc('second', ts) AS updated_at, op,
  CASE WHEN op = 'd' THEN 1 ELSE 0 END AS is_deleted, date_trunc('second', ts) AS cdc_ts,
  TIMESTAMP '2024-02-01 00:00:00' AS dw_ingested_at, 7 AS dw_batch_id FROM v_patient_change""",
)
def staging_rows(spark: SparkSession, sf: str) -> DataFrame:
    cfg = TABLES["patient"]
    changes = (
        view(spark, sf, "v_patient_change")
        .withColumnRenamed("birth_days", "date_of_birth")
        .withColumns({c: F.unix_micros("ts") for c in ("created_at", "updated_at")})
    )
    raw = messages(changes, cfg, cfg.topic())
    rows = staging.to_staging(cdc.decode(raw, cfg, ingested_at=ingested()), cfg, batch_id=7)
    return rows.drop("source_partition", "source_offset")


@query(
    "replace_latest",
    with_views("v_change")
    + """SELECT kafka_offset, slot_id, doctor_id, slot_date_days, slot_code, slot_status, op, ts
FROM (SELECT *, row_number() OVER (PARTITION BY slot_id ORDER BY date_trunc('second', ts) DESC, kafka_offset DESC)
  AS rn FROM v_change) WHERE rn = 1""",
)
def replace_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "v_change").withColumn("second", F.date_trunc("second", "ts"))
    return latest.replace_latest(rows, ["slot_id"], ["second", "kafka_offset"]).drop("second")


@query(
    "replace_latest_composite",
    with_views("v_change")
    + """SELECT slot_id, day, slot_status, kafka_offset FROM (
  SELECT slot_id, CAST(ts AS DATE) AS day, slot_status, kafka_offset,
    row_number() OVER (PARTITION BY slot_id, CAST(ts AS DATE) ORDER BY kafka_offset DESC) AS rn FROM v_change)
WHERE rn = 1""",
)
def replace_latest_composite(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "v_change").select(
        "slot_id", F.col("ts").cast("date").alias("day"), "slot_status", "kafka_offset"
    )
    return latest.replace_latest(rows, ["slot_id", "day"], ["kafka_offset"])


_KNOWN = """known AS (SELECT slot_id, doctor_id, slot_date, slot_code FROM (
  SELECT *, row_number() OVER (PARTITION BY slot_id ORDER BY cdc_ts DESC, source_offset DESC) AS rn
  FROM v_slot_version WHERE op <> 'd') WHERE rn = 1)"""
_STAMPS = """CASE WHEN f.op = 'd' THEN 1 ELSE 0 END AS is_deleted, f.cdc_ts AS dw_updated_at,
  f.source_offset AS dw_version"""
_SLOT_COLUMNS = """coalesce(s.doctor_id, '') AS doctor_id, s.slot_date, coalesce(s.slot_code, '') AS slot_code"""

FACT_APPOINTMENT = (
    with_views("v_slot_version", "v_appointment_version")
    + f""", {_KNOWN}, fact AS (SELECT f.appointment_id, f.booking_ref, f.slot_id, {_SLOT_COLUMNS}, f.patient_id,
  f.booked_at, 1 AS appointment_count, {_STAMPS}
FROM v_appointment_version f LEFT JOIN known s ON f.slot_id = s.slot_id) """
)
FACT_TRANSACTION = (
    with_views("v_slot_version", "v_txn_version")
    + f""", {_KNOWN}, fact AS (SELECT f.transaction_id, f.slot_id, {_SLOT_COLUMNS}, f.patient_id, f.action,
  f.created_at, 1 AS event_count, CAST(f.action = 'BOOKED' AS INT) AS is_booked_event,
  CAST(f.action = 'CONFIRMED' AS INT) AS is_confirmed_event, CAST(f.action = 'CANCELLED' AS INT) AS is_cancelled_event,
  CAST(f.action = 'COMPLETED' AS INT) AS is_completed_event, CAST(f.action = 'NO_SHOW' AS INT) AS is_no_show_event,
  {_STAMPS}
FROM v_txn_version f LEFT JOIN known s ON f.slot_id = s.slot_id) """
)
FACT_RECORD = (
    with_views("v_slot_version", "v_record_version")
    + f""", {_KNOWN}, fact AS (SELECT f.record_id, f.slot_id, {_SLOT_COLUMNS}, f.patient_id, f.version_number,
  f.diagnosis_note, f.prescription_note, 1 AS record_count, {_STAMPS}
FROM v_record_version f LEFT JOIN known s ON f.slot_id = s.slot_id) """
)
FACT_SLOT = (
    with_views("v_slot_version")
    + f""", fact AS (SELECT slot_id, doctor_id, slot_date, slot_code, slot_status, 1 AS slot_count,
  CAST(slot_status = 'AVAILABLE' AS INT) AS is_available, CAST(slot_status = 'BOOKED' AS INT) AS is_booked,
  CAST(slot_status = 'BLOCKED' AS INT) AS is_blocked, CAST(slot_status = 'CANCELLED' AS INT) AS is_cancelled,
  {_STAMPS} FROM v_slot_version f) """
)


def _fact_current(fact: str, key: str, columns: list[str], nullable: list[str]) -> str:
    plain = ", ".join(f"arg_max({{'v': {c}}}, o)['v'] AS {c}" for c in columns)
    loose = "".join(f", arg_max({c}, o) AS {c}" for c in nullable)
    return (
        fact
        + f"""SELECT {key}, {plain}{loose}, max(dw_updated_at) AS latest_dw_updated_at
FROM (SELECT *, (dw_updated_at, dw_version) AS o FROM fact) GROUP BY {key} HAVING arg_max(is_deleted, o) = 0"""
    )


def appointment_fact(spark: SparkSession, sf: str) -> DataFrame:
    slots = warehouse.slot_attributes(staged_version(spark, sf, "v_slot_version"))
    return warehouse.fact_appointment(staged_version(spark, sf, "v_appointment_version"), slots)


def transaction_fact(spark: SparkSession, sf: str) -> DataFrame:
    slots = warehouse.slot_attributes(staged_version(spark, sf, "v_slot_version"))
    return warehouse.fact_transaction(staged_version(spark, sf, "v_txn_version"), slots)


def record_fact(spark: SparkSession, sf: str) -> DataFrame:
    slots = warehouse.slot_attributes(staged_version(spark, sf, "v_slot_version"))
    return warehouse.fact_record(staged_version(spark, sf, "v_record_version"), slots)


def slot_fact(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.fact_slot_daily(staged_version(spark, sf, "v_slot_version"))


query("fact_appointment", FACT_APPOINTMENT + "SELECT * FROM fact")(appointment_fact)
query("fact_transaction", FACT_TRANSACTION + "SELECT * FROM fact")(transaction_fact)
query("fact_record", FACT_RECORD + "SELECT * FROM fact")(record_fact)
query("fact_slot_daily", FACT_SLOT + "SELECT * FROM fact")(slot_fact)


@query(
    "fact_current_appointment",
    _fact_current(
        FACT_APPOINTMENT,
        "appointment_id",
        ["booking_ref", "slot_id", "doctor_id", "patient_id", "slot_code", "appointment_count", "is_deleted"],
        ["slot_date", "booked_at"],
    ),
)
def fact_current_appointment(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.current(appointment_fact(spark, sf), "fact_appointment")


@query(
    "fact_current_transaction",
    _fact_current(
        FACT_TRANSACTION,
        "transaction_id",
        ["slot_id", "doctor_id", "patient_id", "slot_code", "action", "event_count", "is_deleted"]
        + [f"is_{a}_event" for a in ("booked", "confirmed", "cancelled", "completed", "no_show")],
        ["slot_date", "created_at"],
    ),
)
def fact_current_transaction(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.current(transaction_fact(spark, sf), "fact_appointment_transaction")


@query(
    "fact_current_slot",
    _fact_current(
        FACT_SLOT,
        "slot_id",
        ["doctor_id", "slot_code", "slot_status", "slot_count", "is_deleted"]
        + [f"is_{a}" for a in ("available", "booked", "blocked", "cancelled")],
        ["slot_date"],
    ),
)
def fact_current_slot(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.current(slot_fact(spark, sf), "fact_slot_daily")


@query(
    "fact_current_record",
    _fact_current(
        FACT_RECORD,
        "record_id",
        ["slot_id", "doctor_id", "patient_id", "slot_code", "version_number", "diagnosis_note",
         "prescription_note", "record_count", "is_deleted"],
        ["slot_date"],
    ),
)
def fact_current_record(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.current(record_fact(spark, sf), "fact_medical_record")


@query(
    "fact_compacted",
    FACT_APPOINTMENT
    + """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY appointment_id
  ORDER BY dw_updated_at DESC, dw_version DESC) AS rn FROM fact) WHERE rn = 1""",
)
def fact_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Facts written while no slot was known, reduced to one row per key and repaired."""
    versions = staged_version(spark, sf, "v_slot_version")
    slots = warehouse.slot_attributes(versions)
    early = warehouse.fact_appointment(
        staged_version(spark, sf, "v_appointment_version"), slots.filter(F.lit(False))
    )
    kept = plan.compact("fact_appointment", early)
    latest_rows = latest.replace_latest(kept, ["appointment_id"], warehouse.ORDER)
    return warehouse.refresh_slot_columns(latest_rows, slots)


@query(
    "current_after_compaction",
    _fact_current(
        FACT_APPOINTMENT,
        "appointment_id",
        ["booking_ref", "slot_id", "doctor_id", "patient_id", "slot_code", "appointment_count", "is_deleted"],
        ["slot_date", "booked_at"],
    ),
)
def current_after_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """Versions with NULLs and deletes, compacted, joined by more that are partly older, compacted
    again, and joined by the rest: the current view is that of all versions."""
    fact = appointment_fact(spark, sf)
    third = F.col("dw_version") % 3
    state = plan.compact("fact_appointment", fact.filter(third == 1))
    state = plan.compact("fact_appointment", state.unionByName(fact.filter(third == 0)))
    return warehouse.current(state.unionByName(fact.filter(third == 2)), "fact_appointment")
