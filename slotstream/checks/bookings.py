"""Queries on bookings and on set-based mutations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.checks.base import query
from slotstream.functions import calendar, text
from slotstream.operators import booking, mutations, schedule
from slotstream.testdata import view, with_views


@query(
    "rebuild_appointments",
    with_views("v_txn")
    + """SELECT transaction_id AS booking_ref, slot_id, patient_id, created_at AS booked_at FROM (
  SELECT *, row_number() OVER (PARTITION BY slot_id ORDER BY created_at DESC, transaction_id DESC) AS rn FROM v_txn)
WHERE rn = 1 AND action = 'BOOKED'""",
)
def rebuild_appointments(spark: SparkSession, sf: str) -> DataFrame:
    return booking.rebuild_appointments(view(spark, sf, "v_txn"))


_ADMIT = (
    with_views("v_request", "v_slot")
    + """, judged AS (SELECT r.*, CASE WHEN r.slot_id IS NULL OR r.patient_id IS NULL OR r.patient_id = 0
      THEN 'Missing slot_id or patient_id'
    WHEN s.slot_id IS NULL THEN 'Slot not found' WHEN s.admin_status = 'BLOCKED' THEN 'Slot blocked by admin'
    WHEN s.slot_status = 'BLOCKED' THEN 'That slot is blocked' WHEN s.slot_status = 'BOOKED' THEN 'Slot already booked'
    WHEN row_number() OVER (PARTITION BY r.slot_id ORDER BY requested_at, request_id) = 1 THEN 'Booked successfully'
    ELSE 'Slot already booked' END AS message
  FROM v_request r LEFT JOIN v_slot s ON s.slot_id = r.slot_id),
won AS (SELECT *, row_number() OVER (ORDER BY requested_at, request_id) AS n FROM judged
  WHERE message = 'Booked successfully') """
)


@query("booking_admit", _ADMIT + "SELECT *, message = 'Booked successfully' AS success FROM judged")
def booking_admit(spark: SparkSession, sf: str) -> DataFrame:
    return booking.judge_requests(view(spark, sf, "v_request"), view(spark, sf, "v_slot"))


def admitted(spark: SparkSession, sf: str) -> booking.Outcome:
    return booking.admit(
        view(spark, sf, "v_request"),
        view(spark, sf, "v_slot"),
        view(spark, sf, "v_appointment"),
        first_transaction=1001,
        first_appointment=5001,
    )


@query(
    "booking_admit_transactions",
    _ADMIT
    + """SELECT 'TXN26' || lpad(CAST(n + 1000 AS STRING), 8, '0') AS transaction_id, slot_id, patient_id,
  'BOOKED' AS action, requested_at AS created_at FROM won""",
)
def booking_admit_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return admitted(spark, sf).transactions


@query(
    "booking_admit_slots",
    _ADMIT
    + """SELECT slot_id, doctor_id, slot_date, slot_code,
  CASE WHEN slot_id IN (SELECT slot_id FROM won) THEN 'BOOKED' ELSE slot_status END AS slot_status, admin_status
FROM v_slot""",
)
def booking_admit_slots(spark: SparkSession, sf: str) -> DataFrame:
    return admitted(spark, sf).slots


_CANCEL = (
    with_views("v_cancel_request", "v_slot", "v_appointment", "v_patient")
    + """, owned AS (SELECT a.appointment_id, a.slot_id, a.patient_id, p.insurance_number
  FROM v_appointment a JOIN v_patient p ON p.patient_id = a.patient_id),
ranked AS (SELECT r.*, o.appointment_id, o.patient_id,
    row_number() OVER (PARTITION BY o.appointment_id ORDER BY requested_at, request_id) AS rn
  FROM v_cancel_request r JOIN owned o USING (slot_id, insurance_number)),
won AS (SELECT * FROM ranked WHERE rn = 1) """
)


@query(
    "booking_cancel",
    _CANCEL
    + """SELECT r.*, w.appointment_id, w.patient_id, w.request_id IS NOT NULL AS success,
  CASE WHEN w.request_id IS NULL THEN 'Not your booking' ELSE 'Cancelled' END AS message
FROM v_cancel_request r LEFT JOIN won w USING (request_id)""",
)
def booking_cancel(spark: SparkSession, sf: str) -> DataFrame:
    return booking.judge_cancellations(
        *[view(spark, sf, v) for v in ("v_cancel_request", "v_appointment", "v_patient")]
    )


@query(
    "booking_cancel_appointments",
    _CANCEL + "SELECT * FROM v_appointment WHERE appointment_id NOT IN (SELECT appointment_id FROM won)",
)
def booking_cancel_appointments(spark: SparkSession, sf: str) -> DataFrame:
    return booking.cancel(
        *[view(spark, sf, v) for v in ("v_cancel_request", "v_slot", "v_appointment", "v_patient")]
    ).appointments


# existing slots regenerated: every slot again, opened, and a copy of it one year later
_REGENERATED = """, fresh AS (SELECT slot_id, doctor_id, slot_date, slot_code, 'AVAILABLE' AS slot_status,
    CASE WHEN slot_status = 'BLOCKED' THEN 'BLOCKED' ELSE 'AVAILABLE' END AS admin_status FROM v_slot
  UNION ALL SELECT 'N' || slot_id, doctor_id, slot_date + 365, slot_code, 'BLOCKED', 'AVAILABLE' FROM v_slot)"""


def regenerated(rows: DataFrame) -> DataFrame:
    again = rows.withColumns(
        {
            "admin_status": F.when(F.col("slot_status") == "BLOCKED", F.lit("BLOCKED")).otherwise(
                F.lit("AVAILABLE")
            ),
            "slot_status": F.lit("AVAILABLE"),
        }
    )
    later = rows.withColumns(
        {
            "slot_id": F.concat(F.lit("N"), "slot_id"),
            "slot_date": F.date_add("slot_date", 365),
            "slot_status": F.lit("BLOCKED"),
            "admin_status": F.lit("AVAILABLE"),
        }
    )
    return again.unionByName(later)


@query(
    "merge_slots_guarded",
    with_views("v_slot")
    + _REGENERATED
    + """SELECT f.slot_id, f.doctor_id, f.slot_date, f.slot_code,
  CASE WHEN s.slot_status = 'BOOKED' THEN 'BOOKED' ELSE f.slot_status END AS slot_status, f.admin_status
FROM fresh f LEFT JOIN v_slot s ON s.slot_id = f.slot_id""",
)
def merge_slots_guarded(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "v_slot")
    return schedule.merge_slots(rows, regenerated(rows))


@query(
    "insert_ignore",
    with_views("v_appointment", "v_txn")
    + """, fresh AS (SELECT CAST(NULL AS INT) AS appointment_id, transaction_id AS booking_ref, slot_id, patient_id,
    created_at AS booked_at, row_number() OVER (PARTITION BY slot_id ORDER BY created_at, transaction_id) AS rn FROM v_txn)
SELECT * FROM v_appointment UNION ALL
SELECT * EXCLUDE (rn) FROM fresh WHERE rn = 1 AND slot_id NOT IN (SELECT slot_id FROM v_appointment)""",
)
def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    current = view(spark, sf, "v_appointment")
    new = view(spark, sf, "v_txn").select(
        F.lit(None).cast("int").alias("appointment_id"),
        F.col("transaction_id").alias("booking_ref"),
        "slot_id",
        "patient_id",
        F.col("created_at").alias("booked_at"),
    )
    return mutations.insert_ignore(current, new, ["slot_id"], order=["booked_at", "booking_ref"])


@query(
    "upsert_calendar",
    with_views("v_calendar", "v_txn")
    + """, changed AS (SELECT DISTINCT CAST(created_at AS DATE) AS date FROM v_txn
  UNION SELECT date FROM v_calendar WHERE status = 'WEEKEND')
SELECT coalesce(c.date, n.date) AS date, CASE WHEN n.date IS NOT NULL THEN 'HOLIDAY' ELSE c.status END AS status
FROM v_calendar c FULL JOIN changed n ON n.date = c.date""",
)
def upsert_calendar(spark: SparkSession, sf: str) -> DataFrame:
    days = view(spark, sf, "v_calendar")
    logged = view(spark, sf, "v_txn").select(F.col("created_at").cast("date").alias("date"))
    new = logged.union(days.filter("status = 'WEEKEND'").select("date")).distinct()
    return mutations.upsert(days, new.withColumn("status", F.lit("HOLIDAY")), ["date"])


@query(
    "delete_keys",
    with_views("v_appointment", "v_txn")
    + "SELECT * FROM v_appointment WHERE slot_id NOT IN (SELECT slot_id FROM v_txn)",
)
def delete_keys(spark: SparkSession, sf: str) -> DataFrame:
    return mutations.delete_keys(view(spark, sf, "v_appointment"), view(spark, sf, "v_txn"), ["slot_id"])


@query(
    "update_rows",
    with_views("v_patient", "v_appointment")
    + """SELECT p.patient_id, CASE WHEN c.patient_id IS NULL THEN patient_name ELSE 'Renamed ' || c.n END AS patient_name,
  CASE WHEN c.patient_id IS NULL THEN address END AS address, phone_number, insurance_number, date_of_birth, gender, email,
  CASE WHEN c.patient_id IS NULL THEN TIMESTAMP '2020-01-01' ELSE TIMESTAMP '2026-01-01' END AS updated_at
FROM v_patient p LEFT JOIN (SELECT patient_id, count(*) AS n FROM v_appointment GROUP BY patient_id) c
  ON c.patient_id = p.patient_id""",
)
def update_rows(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.lit("2020-01-01 00:00:00").cast("timestamp")
    patients = view(spark, sf, "v_patient").withColumn("updated_at", stamp)
    changes = (
        view(spark, sf, "v_appointment")
        .groupBy("patient_id")
        .agg(F.concat(F.lit("Renamed "), F.count(F.lit(1)).cast("string")).alias("patient_name"))
    )
    now = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp")
    return mutations.update_rows(
        patients, changes, ["patient_id"], ["patient_name", "address"], now=now
    )


_CASCADE = (
    with_views("v_slot", "v_txn", "v_appointment", "v_calendar")
    + """, change AS (SELECT date, CASE WHEN status = 'WEEKEND' THEN 'HOLIDAY' ELSE 'NORMAL_DAY' END AS status
  FROM v_calendar WHERE status <> 'NORMAL_DAY'),
closed AS (SELECT slot_id FROM v_slot WHERE slot_date IN (SELECT date FROM change WHERE status = 'HOLIDAY')) """
)


def cascade(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Sundays become holidays, the holidays become ordinary days."""
    days = view(spark, sf, "v_calendar")
    changed = F.when(F.col("status") == "WEEKEND", F.lit("HOLIDAY")).otherwise(F.lit("NORMAL_DAY"))
    changes = days.filter("status <> 'NORMAL_DAY'").withColumn("status", changed)
    return schedule.holiday_cascade(
        changes, days, *[view(spark, sf, v) for v in ("v_txn", "v_appointment", "v_slot")]
    )


@query(
    "holiday_cascade_slots",
    _CASCADE
    + """SELECT slot_id, doctor_id, slot_date, slot_code,
  CASE WHEN c.status = 'HOLIDAY' AND slot_status = 'BOOKED' THEN 'AVAILABLE' ELSE slot_status END AS slot_status,
  CASE WHEN c.status = 'HOLIDAY' THEN 'BLOCKED' WHEN c.status IS NOT NULL THEN 'AVAILABLE' ELSE admin_status END
    AS admin_status
FROM v_slot LEFT JOIN change c ON c.date = slot_date""",
)
def holiday_cascade_slots(spark: SparkSession, sf: str) -> DataFrame:
    return cascade(spark, sf)["slots"]


@query(
    "holiday_cascade_transactions",
    _CASCADE
    + """SELECT * REPLACE (CASE WHEN slot_id IN (SELECT slot_id FROM closed) THEN 'CANCELLED' ELSE action END AS action)
FROM v_txn""",
)
def holiday_cascade_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return cascade(spark, sf)["transactions"]


@query(
    "holiday_cascade_appointments",
    _CASCADE + "SELECT * FROM v_appointment WHERE slot_id NOT IN (SELECT slot_id FROM closed)",
)
def holiday_cascade_appointments(spark: SparkSession, sf: str) -> DataFrame:
    return cascade(spark, sf)["appointments"]


@query(
    "holiday_cascade_calendar",
    _CASCADE
    + "SELECT v.date, coalesce(c.status, v.status) AS status FROM v_calendar v LEFT JOIN change c ON c.date = v.date",
)
def holiday_cascade_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return cascade(spark, sf)["calendar"]


@query(
    "sequence_ids",
    with_views("v_txn")
    + """SELECT transaction_id, 'REC26' || lpad(CAST(99 + row_number() OVER (ORDER BY created_at, transaction_id) AS STRING), 8, '0')
  AS record_id FROM v_txn""",
)
def sequence_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "v_txn").select("created_at", "transaction_id")
    return mutations.with_sequence_ids(
        rows, ["created_at", "transaction_id"], "record_id", prefix="REC26", width=8, start=100
    ).drop("created_at")


@query(
    "payment_defaults",
    """SELECT o_orderkey AS payment_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount_total,
  CAST(CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 0 END AS DECIMAL(12,2)) AS amount_covered,
  CAST(0 AS DECIMAL(12,2)) AS amount_patient_responsibility,
  CASE WHEN o_orderstatus = 'P' THEN 'PAID' ELSE 'PENDING' END AS payment_status FROM orders""",
)
def payment_defaults(spark: SparkSession, sf: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    state = F.col("o_orderstatus")
    payments = orders.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount_total"),
        F.when(state == "F", F.lit(10)).cast("decimal(12,2)").alias("amount_covered"),
        F.lit(None).cast("decimal(12,2)").alias("amount_patient_responsibility"),
        F.when(state == "P", F.lit("PAID")).alias("payment_status"),
    )
    return mutations.with_defaults(payments, mutations.PAYMENT_DEFAULTS)


@query(
    "append_payments",
    """SELECT CAST(o_orderkey AS BIGINT) AS payment_id, CAST(o_orderkey AS INT) AS appointment_id,
  CAST(o_totalprice AS DECIMAL(12,2)) AS amount_total,
  CAST(CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 0 END AS DECIMAL(12,2)) AS amount_covered,
  CAST(0 AS DECIMAL(12,2)) AS amount_patient_responsibility, 'PENDING' AS payment_status,
  TIMESTAMP '2024-03-01 12:00:00' AS created_at, TIMESTAMP '2024-03-01 12:00:00' AS updated_at FROM orders""",
)
def append_payments(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as payments, those of status F first, as text; the rest lack most columns."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    now = F.lit("2024-03-01 12:00:00").cast("timestamp")
    ids = [F.col("o_orderkey").alias("payment_id"), F.col("o_orderkey").alias("appointment_id")]
    total = F.col("o_totalprice").alias("amount_total")
    paid = orders.filter("o_orderstatus = 'F'").select(
        *[c.cast("string") for c in ids], total, F.lit("10").alias("amount_covered")
    )
    rest = orders.filter("o_orderstatus <> 'F'").select(*ids, total)
    return mutations.append_payments(mutations.payment_rows(paid, now=now), rest, now=now)


@query(
    "text_functions",
    """SELECT event_id, CASE WHEN length(CAST(event_id AS STRING)) >= 4 THEN CAST(event_id AS STRING)
    ELSE lpad(CAST(event_id AS STRING), 4, '0') END AS filled,
  CAST(isodow(ts) AS STRING) || '_' || upper(event_type) AS pattern_key, CAST(isodow(ts) AS INT) AS dow,
  upper(event_type) AS slot_code, date_trunc('second', ts) AS event_time,
  date_trunc('minute', ts) AS clock_time
FROM events""",
)
def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    weekday = calendar.iso_weekday(F.col("ts").cast("date"))
    keyed = events.withColumn("pattern_key", text.pattern_key(weekday, F.upper("event_type")))
    dow, code = text.split_pattern_key(F.col("pattern_key"))
    return keyed.select(
        "event_id",
        text.zero_fill(F.col("event_id"), 4).alias("filled"),
        "pattern_key",
        dow.alias("dow"),
        code.alias("slot_code"),
        text.parse_event_time(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("event_time"),
        text.parse_twelve_hour(F.lower(F.date_format("ts", "yyyy-MM-dd hh:mma"))).alias("clock_time"),
    )
