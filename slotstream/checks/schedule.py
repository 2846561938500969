"""Queries on slots, calendar and schedules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.checks.base import query
from slotstream.functions import calendar, status
from slotstream.operators import schedule, slots
from slotstream.testdata import view, with_views

MAY = (2026, 5)
TODAY = "DATE '1998-06-15'"


def today() -> Column:
    return F.lit(dt.date(1998, 6, 15))


_AVAILABILITY = (
    with_views("v_slot", "v_appointment")
    + """, booked AS (SELECT DISTINCT ON (doctor_id, slot_date, slot_code) s.*, a.patient_id FROM v_slot s
  LEFT JOIN v_appointment a ON s.slot_id = a.slot_id ORDER BY doctor_id, slot_date, slot_code, s.slot_id DESC),
grid AS (SELECT d.doctor_id, d.slot_date, c.slot_code FROM (SELECT DISTINCT doctor_id, slot_date FROM v_slot) d,
  v_slot_code c),
shown AS (SELECT g.doctor_id, g.slot_date, g.slot_code, b.slot_id,
  CASE WHEN coalesce(b.patient_id, 0) <> 0 THEN 'BOOKED' WHEN b.admin_status = 'BLOCKED' THEN 'BLOCKED'
       WHEN b.slot_status = 'AVAILABLE' THEN 'AVAILABLE' ELSE 'NOT_AVAILABLE' END AS slot_status,
  coalesce(b.admin_status, 'AVAILABLE') AS admin_status, b.patient_id
FROM grid g LEFT JOIN booked b USING (doctor_id, slot_date, slot_code)) """
)


@query("slot_availability", _AVAILABILITY + "SELECT * FROM shown")
def slot_availability(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "v_slot")
    return slots.availability(rows, rows, view(spark, sf, "v_appointment"))


@query(
    "patient_in_slot",
    with_views("v_slot", "v_appointment")
    + """SELECT s.doctor_id, s.slot_date, s.slot_code, a.patient_id FROM v_slot s JOIN v_appointment a
ON s.slot_id = a.slot_id WHERE s.slot_status = 'BOOKED' AND s.admin_status = 'AVAILABLE'""",
)
def patient_in_slot(spark: SparkSession, sf: str) -> DataFrame:
    return slots.patient_in_slot(view(spark, sf, "v_slot"), view(spark, sf, "v_appointment"))


@query(
    "doctor_view_status",
    with_views("v_slot")
    + f"""SELECT slot_id, CASE WHEN slot_status IS NULL THEN 'NOT AVAILABLE' WHEN admin_status = 'BLOCKED'
  THEN 'BLOCKED BY ADMIN' WHEN slot_status = 'BOOKED' THEN 'BOOKED'
  WHEN slot_date <= {TODAY} THEN CASE WHEN slot_status = 'BLOCKED' THEN 'LOCKED: DOCTOR BLOCKED'
    ELSE 'LOCKED: ' || slot_status END ELSE slot_status END AS seen FROM v_slot""",
)
def doctor_view_status(spark: SparkSession, sf: str) -> DataFrame:
    seen = status.doctor_view(F.col("slot_status"), F.col("admin_status"), F.col("slot_date"), today())
    return view(spark, sf, "v_slot").select("slot_id", seen.alias("seen"))


@query(
    "patient_view_status",
    with_views("v_slot", "v_appointment")
    + """SELECT s.slot_id, CASE WHEN slot_status IN ('AVAILABLE', 'BOOKED', 'BLOCKED') THEN slot_status
  ELSE 'NOT_AVAILABLE' END AS seen,
  CASE WHEN slot_status = 'BOOKED' AND a.patient_id = 42 THEN 1 ELSE 0 END AS mine
FROM v_slot s LEFT JOIN v_appointment a ON a.slot_id = s.slot_id""",
)
def patient_view_status(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "v_slot").join(
        view(spark, sf, "v_appointment").select("slot_id", "patient_id"), "slot_id", "left"
    )
    shown = F.col("slot_status")
    return rows.select(
        "slot_id",
        status.patient_view(shown).alias("seen"),
        status.owned_by(shown, F.col("patient_id"), F.lit(42)).alias("mine"),
    )


@query(
    "lead_time_ok",
    with_views("v_slot") + f"SELECT slot_id, slot_date >= {TODAY} + 2 AS lead_time_ok FROM v_slot",
)
def lead_time_ok(spark: SparkSession, sf: str) -> DataFrame:
    rule = calendar.lead_time_ok(F.col("slot_date"), today())
    return view(spark, sf, "v_slot").select("slot_id", rule.alias("lead_time_ok"))


@query(
    "editable_months",
    with_views("v_slot")
    + f"""SELECT slot_id, slot_date > {TODAY} AS slot_editable, slot_date >= DATE '1998-08-01' AS month_editable
FROM v_slot""",
)
def editable_months(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("slot_date")
    return view(spark, sf, "v_slot").select(
        "slot_id",
        calendar.slot_editable(day, today()).alias("slot_editable"),
        calendar.month_editable(day, today()).alias("month_editable"),
    )


@query(
    "month_ends",
    with_views("v_slot")
    + """SELECT slot_id, CAST(date_trunc('month', slot_date) AS DATE) AS first_day, last_day(slot_date) AS last_day
FROM v_slot""",
)
def month_ends(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("slot_date")
    return view(spark, sf, "v_slot").select(
        "slot_id",
        calendar.month_start(day).alias("first_day"),
        calendar.month_end(day).alias("last_day"),
    )


@query(
    "calendar_days",
    """SELECT d AS date, CASE WHEN (month(d), day(d)) IN ((1, 1), (4, 30), (5, 1)) THEN 'HOLIDAY'
  WHEN isodow(d) = 7 THEN 'WEEKEND' ELSE 'NORMAL_DAY' END AS status, upper(strftime(d, '%a')) AS weekday_name
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def calendar_days(spark: SparkSession, sf: str) -> DataFrame:
    days = view(spark, sf, "v_slot").select(F.col("slot_date").alias("date")).distinct()
    return schedule.classify_days(days)


@query(
    "calendar_range",
    with_views("v_calendar")
    + "SELECT date, status FROM v_calendar WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'",
)
def calendar_range(spark: SparkSession, sf: str) -> DataFrame:
    days = schedule.classify_days(view(spark, sf, "v_calendar").select("date"))
    return schedule.calendar_range(days, dt.date(1998, 1, 1), dt.date(1998, 6, 30)).select("date", "status")


@query(
    "month_options",
    """SELECT d AS today, CAST(m AS DATE) AS month_start FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
  generate_series(date_trunc('month', d) + INTERVAL 2 MONTH, TIMESTAMP '2050-12-01', INTERVAL 1 MONTH) AS g(m)""",
)
def month_options(spark: SparkSession, sf: str) -> DataFrame:
    """Months open for generation, as of every day that has slots."""
    days = view(spark, sf, "v_slot").select(F.col("slot_date").alias("today")).distinct()
    months = calendar.selectable_months(F.col("today"))
    return days.select("today", F.explode(months).alias("month_start"))


_LOCKS = """, locks AS (SELECT doctor_id, CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month, false AS is_inserted
  FROM v_doctor, generate_series(TIMESTAMP '2026-05-01', TIMESTAMP '2050-12-01', INTERVAL 1 MONTH) AS g(m))"""


def locks(spark: SparkSession, sf: str) -> DataFrame:
    return schedule.month_locks(view(spark, sf, "v_doctor"))


@query("month_locks", with_views("v_doctor") + _LOCKS + " SELECT * FROM locks")
def month_locks(spark: SparkSession, sf: str) -> DataFrame:
    return locks(spark, sf)


@query(
    "month_status",
    with_views("v_doctor") + _LOCKS + " SELECT doctor_id, is_inserted FROM locks WHERE year = 2026 AND month = 7",
)
def month_status(spark: SparkSession, sf: str) -> DataFrame:
    return schedule.month_status(locks(spark, sf), None, 2026, 7)


_PREVIEW = """, preview AS (SELECT doctor_id, CAST(isodow(slot_date) AS INT) AS dow, slot_code, count(*) AS cnt,
  CASE WHEN count(*) >= 2 THEN 'GREEN' ELSE 'RED' END AS flag FROM v_slot_month
  WHERE slot_status = 'AVAILABLE' AND slot_date >= DATE '2026-04-01' AND slot_date < DATE '2026-05-01'
    AND isodow(slot_date) BETWEEN 1 AND 6 GROUP BY ALL)"""


@query("schedule_preview", with_views("v_slot_month") + _PREVIEW + " SELECT * FROM preview")
def schedule_preview(spark: SparkSession, sf: str) -> DataFrame:
    return schedule.preview(view(spark, sf, "v_slot_month"), *MAY)


@query(
    "preview_grid",
    with_views("v_slot_month", "v_doctor")
    + _PREVIEW
    + """SELECT d.doctor_id, CAST(w.dow AS INT) AS dow, c.slot_code,
  CASE WHEN p.flag = 'GREEN' THEN 'AVAILABLE' ELSE 'NOT AVAILABLE' END AS state
FROM v_doctor d, generate_series(1, 6) AS w(dow), v_slot_code c
LEFT JOIN preview p ON p.doctor_id = d.doctor_id AND p.dow = w.dow AND p.slot_code = c.slot_code""",
)
def preview_grid(spark: SparkSession, sf: str) -> DataFrame:
    return schedule.preview_grid(view(spark, sf, "v_doctor"), schedule_preview(spark, sf))


# May 2026 with the holidays of the calendar
_GENERATED = (
    _PREVIEW
    + """, month_days AS (SELECT CAST(d AS DATE) AS slot_date, CAST(isodow(d) AS INT) AS dow,
    (month(d), day(d)) IN ((1, 1), (4, 30), (5, 1)) AS holiday
  FROM generate_series(TIMESTAMP '2026-05-01', TIMESTAMP '2026-05-31', INTERVAL 1 DAY) AS g(d)),
generated AS (SELECT strftime(m.slot_date, '%Y%m%d') || d.doctor_id || c.slot_code AS slot_id, d.doctor_id, m.slot_date,
    c.slot_code, CASE WHEN m.holiday THEN 'BLOCKED' WHEN p.flag = 'GREEN' THEN 'AVAILABLE' ELSE 'BLOCKED' END
      AS slot_status, CASE WHEN m.holiday THEN 'BLOCKED' ELSE 'AVAILABLE' END AS admin_status
  FROM due d CROSS JOIN month_days m CROSS JOIN v_slot_code c
  LEFT JOIN preview p ON p.doctor_id = d.doctor_id AND p.dow = m.dow AND p.slot_code = c.slot_code
  WHERE m.dow <> 7)"""
)


@query(
    "schedule_generate",
    with_views("v_slot_month", "v_doctor")
    + ", due AS (SELECT doctor_id FROM v_doctor)"
    + _GENERATED
    + " SELECT * FROM generated",
)
def schedule_generate(spark: SparkSession, sf: str) -> DataFrame:
    return schedule.generate(
        view(spark, sf, "v_doctor"),
        schedule.green(schedule_preview(spark, sf)),
        schedule.calendar_days(spark),
        *MAY,
    )


_AUTO = (
    with_views("v_slot_month", "v_doctor", "v_slot")
    + """, due AS (SELECT doctor_id FROM v_doctor WHERE start_working_date IS NOT NULL AND doctor_id IN (
  SELECT doctor_id FROM v_slot_month WHERE slot_status = 'AVAILABLE' AND isodow(slot_date) <= 6
  GROUP BY doctor_id, isodow(slot_date), slot_code HAVING count(*) >= 2))"""
    + _GENERATED
)


def auto_plan(spark: SparkSession, sf: str) -> schedule.MonthPlan:
    """May 2026, where the month of the doctors without a first day at work is locked already."""
    doctors = view(spark, sf, "v_doctor")
    done = schedule.lock_months(locks(spark, sf), doctors.filter("start_working_date IS NULL"), *MAY)
    return schedule.auto_generate(
        doctors, view(spark, sf, "v_slot_month"), done, schedule.calendar_days(spark), dt.date(2026, 4, 30)
    )


@query(
    "schedule_auto",
    _AUTO + " SELECT * FROM v_slot_month UNION ALL SELECT * FROM generated",
)
def schedule_auto(spark: SparkSession, sf: str) -> DataFrame:
    return auto_plan(spark, sf).slots


@query(
    "schedule_auto_locks",
    _AUTO
    + _LOCKS
    + """ SELECT doctor_id, year, month, year = 2026 AND month = 5 AND (start_working_date IS NULL
  OR doctor_id IN (SELECT doctor_id FROM due)) AS is_inserted FROM locks JOIN v_doctor USING (doctor_id)""",
)
def schedule_auto_locks(spark: SparkSession, sf: str) -> DataFrame:
    return auto_plan(spark, sf).locks


@query(
    "slot_update_verdicts",
    with_views("v_slot", "v_update", "v_calendar", "v_appointment")
    + """, here AS (SELECT DISTINCT ON (doctor_id, slot_date, slot_code) doctor_id, slot_date, slot_code, s.slot_id,
    s.slot_id IN (SELECT slot_id FROM v_appointment) AS taken
  FROM v_slot s ORDER BY doctor_id, slot_date, slot_code, s.slot_id DESC),
judged AS (SELECT u.*, h.slot_id AS known, CASE
    WHEN u.slot_date IN (SELECT date FROM v_calendar WHERE status = 'HOLIDAY')
      THEN 'Cannot modify slots. This date is blocked by Admin.'
    WHEN h.taken AND u.status <> 'BOOKED' THEN 'Cannot change status of a booked slot'
    WHEN h.slot_id IS NOT NULL THEN 'Slot updated'
    WHEN row_number() OVER (PARTITION BY u.doctor_id, u.slot_date, u.slot_code ORDER BY requested_at, update_id) = 1
      THEN 'Slot created' ELSE 'Slot updated' END AS message
  FROM v_update u LEFT JOIN here h USING (doctor_id, slot_date, slot_code))
SELECT update_id, doctor_id, slot_date, slot_code, status, requested_at,
  CASE WHEN message LIKE 'Slot %' THEN coalesce(known, strftime(slot_date, '%Y%m%d') || doctor_id || slot_code) END AS slot_id,
  message LIKE 'Slot %' AS success, message FROM judged""",
)
def slot_update_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    return slots.judge_updates(
        *[view(spark, sf, v) for v in ("v_slot", "v_update", "v_calendar", "v_appointment")]
    )


@query(
    "slot_updates_applied",
    with_views("v_slot", "v_update", "v_calendar", "v_appointment")
    + """, here AS (SELECT DISTINCT ON (doctor_id, slot_date, slot_code) doctor_id, slot_date, slot_code, s.slot_id,
    s.slot_id IN (SELECT slot_id FROM v_appointment) AS taken
  FROM v_slot s ORDER BY doctor_id, slot_date, slot_code, s.slot_id DESC),
accepted AS (SELECT u.*, coalesce(h.slot_id, strftime(u.slot_date, '%Y%m%d') || u.doctor_id || u.slot_code) AS slot_id,
    row_number() OVER (PARTITION BY u.doctor_id, u.slot_date, u.slot_code ORDER BY requested_at DESC, update_id DESC) AS rn
  FROM v_update u LEFT JOIN here h USING (doctor_id, slot_date, slot_code)
  WHERE u.slot_date NOT IN (SELECT date FROM v_calendar WHERE status = 'HOLIDAY')
    AND NOT (coalesce(h.taken, false) AND u.status <> 'BOOKED')),
final AS (SELECT * FROM accepted WHERE rn = 1)
SELECT s.slot_id, s.doctor_id, s.slot_date, s.slot_code, coalesce(f.status, s.slot_status) AS slot_status, s.admin_status
FROM v_slot s LEFT JOIN final f ON f.slot_id = s.slot_id
UNION ALL
SELECT slot_id, doctor_id, slot_date, slot_code, status, 'AVAILABLE' FROM final
WHERE slot_id NOT IN (SELECT slot_id FROM v_slot)""",
)
def slot_updates_applied(spark: SparkSession, sf: str) -> DataFrame:
    return slots.apply_updates(
        *[view(spark, sf, v) for v in ("v_slot", "v_update", "v_calendar", "v_appointment")]
    )[0]
