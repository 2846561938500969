"""Queries on booking notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.checks.base import query
from slotstream.checks.warehouse import staged_version
from slotstream.operators import notify
from slotstream.sources import topics
from slotstream.testdata import view, with_views

SINCE = "2024-01-10 00:00:00"
NOW = "2024-03-01 12:00:00"


def moment(value: str) -> Column:
    return F.lit(value).cast("timestamp")


_EVENTS = (
    with_views("v_txn_version", "v_slot", "v_patient", "v_doctor")
    + f""", events_out AS (SELECT transaction_id AS notification_key, transaction_id, slot_id, patient_id, action,
  CASE action WHEN 'BOOKED' THEN 'BOOKING_CONFIRMATION' ELSE 'BOOKING_CANCELLATION' END AS event_type,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ') AS event_time, 'EMAIL' AS channel
FROM v_txn_version WHERE op <> 'd' AND action IN ('BOOKED', 'CANCELLED') AND created_at >= TIMESTAMP '{SINCE}'),
audit AS (SELECT transaction_id AS notification_key, CASE WHEN source_offset % 3 = 0 THEN 'SENT'
  WHEN source_offset % 3 = 1 THEN 'FAILED' ELSE 'PENDING' END AS send_status FROM v_txn_version),
fresh AS (SELECT * FROM events_out WHERE notification_key NOT IN
  (SELECT notification_key FROM audit WHERE send_status = 'SENT')),
enriched AS (SELECT e.*, p.patient_name, p.email, s.slot_date, s.slot_code, d.doctor_name, d.specialty,
    p.patient_id IS NOT NULL AND d.doctor_id IS NOT NULL AS found
  FROM fresh e LEFT JOIN v_slot s ON s.slot_id = e.slot_id LEFT JOIN v_patient p ON p.patient_id = e.patient_id
  LEFT JOIN v_doctor d ON d.doctor_id = s.doctor_id),
judged AS (SELECT *, CASE WHEN NOT found THEN 'Cannot find booking details for notification'
  WHEN coalesce(email, '') = '' THEN 'Patient email is null' ELSE '' END AS error_message FROM enriched) """
)


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Notification events as a consumer reads them from their topic."""
    log = staged_version(spark, sf, "v_txn_version")
    selected = notify.dedupe(notify.booking_events(log, moment(SINCE)))
    return topics.notifications(notify.to_messages(selected))


def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    third = F.col("source_offset") % 3
    state = F.when(third == 0, "SENT").when(third == 1, "FAILED").otherwise("PENDING")
    return view(spark, sf, "v_txn_version").select(
        F.col("transaction_id").alias("notification_key"), state.alias("send_status")
    )


def references(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(view(spark, sf, v) for v in ("v_patient", "v_slot", "v_doctor"))


def judged(spark: SparkSession, sf: str) -> DataFrame:
    return notify.outbox(events(spark, sf), audit_log(spark, sf), *references(spark, sf))


@query("notify_events", _EVENTS + "SELECT * FROM events_out")
def notify_events(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf)


@query("notify_not_sent", _EVENTS + "SELECT * FROM fresh")
def notify_not_sent(spark: SparkSession, sf: str) -> DataFrame:
    return notify.not_yet_sent(events(spark, sf), audit_log(spark, sf))


@query("notify_enrich", _EVENTS + "SELECT * FROM enriched")
def notify_enrich(spark: SparkSession, sf: str) -> DataFrame:
    fresh = notify.not_yet_sent(events(spark, sf), audit_log(spark, sf))
    return notify.enrich(fresh, *references(spark, sf))


@query(
    "notify_messages",
    _EVENTS
    + """SELECT notification_key, email AS recipient,
  CASE event_type WHEN 'BOOKING_CONFIRMATION' THEN 'Booking Confirmation' ELSE 'Booking Cancellation' END AS subject,
  'Dear ' || patient_name || ',' || chr(10) || chr(10) || CASE event_type WHEN 'BOOKING_CONFIRMATION'
    THEN 'Your appointment has been booked successfully.' ELSE 'Your appointment has been cancelled.' END
  || chr(10) || chr(10) || 'Doctor: ' || doctor_name || chr(10) || 'Specialty: ' || specialty || chr(10) || 'Date: '
  || CAST(slot_date AS VARCHAR) || chr(10) || 'Slot: ' || slot_code || chr(10) || chr(10) || 'Thank you.' || chr(10) AS body
FROM judged WHERE error_message = ''""",
)
def notify_messages(spark: SparkSession, sf: str) -> DataFrame:
    return notify.outgoing(judged(spark, sf))


AUDIT_SQL = (
    _EVENTS
    + f"""SELECT notification_key, transaction_id, slot_id, patient_id, action, event_type,
  CAST(replace(replace(event_time, 'T', ' '), 'Z', '') AS TIMESTAMP) AS event_time, channel, state AS send_status,
  error_message, TIMESTAMP '{NOW}' AS processed_at, CASE WHEN state = 'SENT' THEN TIMESTAMP '{NOW}' END AS sent_at
FROM (SELECT *, unnest(CASE WHEN error_message = '' THEN ['PENDING', 'SENT'] ELSE ['FAILED'] END) AS state FROM judged)"""
)


@query("notify_audit", AUDIT_SQL)
def notify_audit(spark: SparkSession, sf: str) -> DataFrame:
    return notify.settle(judged(spark, sf), moment(NOW))
