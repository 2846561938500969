"""Notification selection, messages, outbox verdicts and audit rows."""

import datetime as dt
import json

from pyspark.sql import functions as F

from slotstream.operators import notify
from slotstream.sources import topics

NOW = dt.datetime(2026, 5, 2, 12, 0)


def log(spark, *data):
    return spark.createDataFrame(
        list(data),
        "transaction_id string, slot_id string, patient_id long, action string, created_at timestamp, "
        "is_deleted int, cdc_ts timestamp, source_offset long",
    )


def at(second):
    return dt.datetime(2026, 5, 1, 0, 0, second)


def sample(spark):
    return log(
        spark,
        ("T1", "S1", 1, "BOOKED", at(10), 0, at(10), 1),
        ("T1", "S1", 1, "CANCELLED", at(12), 0, at(12), 2),
        ("T2", "S1", 2, "CANCELLED", at(10), 0, at(10), 3),
        ("T3", "S9", 1, "BOOKED", at(10), 0, at(10), 4),
        ("T4", "S1", 1, "CONFIRMED", at(10), 0, at(10), 5),
        ("T5", "S1", 1, "BOOKED", at(9), 0, at(9), 6),
        ("T6", "S1", 1, "BOOKED", at(10), 1, at(10), 7),
    )


def clinic(spark):
    patients = spark.createDataFrame(
        [(1, "Ann", "a@b.c"), (2, "Bo", "")], "patient_id int, patient_name string, email string"
    )
    slots = spark.createDataFrame(
        [("S1", dt.date(2026, 5, 4), "8A", "DR1")], "slot_id string, slot_date date, slot_code string, doctor_id string"
    )
    doctors = spark.createDataFrame([("DR1", "D One", "Skin")], "doctor_id string, doctor_name string, specialty string")
    return patients, slots, doctors


def events(spark):
    chosen = notify.dedupe(notify.booking_events(sample(spark), F.lit(at(10))))
    return topics.notifications(notify.to_messages(chosen))


def test_selection(spark, rows):
    assert rows(events(spark), "notification_key", "event_type", "channel", "event_time") == [
        ("T1", "BOOKING_CONFIRMATION", "EMAIL", "2026-05-01T00:00:10.000Z"),
        ("T2", "BOOKING_CANCELLATION", "EMAIL", "2026-05-01T00:00:10.000Z"),
        ("T3", "BOOKING_CONFIRMATION", "EMAIL", "2026-05-01T00:00:10.000Z"),
    ]


def test_message_is_json_with_the_renamed_time(spark):
    message = notify.to_messages(notify.booking_events(sample(spark), F.lit(at(10)))).filter("key = 'T2'").first()
    assert json.loads(message.value) == {
        "notification_key": "T2",
        "transaction_id": "T2",
        "slot_id": "S1",
        "patient_id": 2,
        "action": "CANCELLED",
        "event_type": "BOOKING_CANCELLATION",
        "event_time": "2026-05-01T00:00:10.000Z",
        "channel": "EMAIL",
    }


def test_outbox(spark, rows):
    audit = spark.createDataFrame(
        [("T9", "SENT"), ("T1", "FAILED"), ("T1", "PENDING")], "notification_key string, send_status string"
    )
    judged = notify.outbox(events(spark), audit, *clinic(spark))
    assert rows(judged, "notification_key", "error_message") == [
        ("T1", ""),
        ("T2", "Patient email is null"),
        ("T3", "Cannot find booking details for notification"),
    ]
    mail = notify.outgoing(judged).collect()
    assert [(m.recipient, m.subject) for m in mail] == [("a@b.c", "Booking Confirmation")]
    assert mail[0].body == (
        "Dear Ann,\n\nYour appointment has been booked successfully.\n\nDoctor: D One\nSpecialty: Skin\n"
        "Date: 2026-05-04\nSlot: 8A\n\nThank you.\n"
    )
    trail = notify.settle(judged, F.lit(NOW))
    assert trail.columns == notify.AUDIT_COLUMNS
    assert rows(trail, "notification_key", "send_status", "sent_at") == [
        ("T1", "PENDING", None),
        ("T1", "SENT", NOW),
        ("T2", "FAILED", None),
        ("T3", "FAILED", None),
    ]


def test_sent_is_not_sent_again(spark, rows):
    audit = spark.createDataFrame(
        [("T1", "SENT"), ("T1", "SENT"), ("T3", "PENDING")], "notification_key string, send_status string"
    )
    assert rows(notify.not_yet_sent(events(spark), audit), "notification_key") == [("T2",), ("T3",)]


def test_unreadable_time_fails(spark, rows):
    late = events(spark).filter("notification_key = 'T1'").withColumn("event_time", F.lit("soon"))
    judged = notify.judge(notify.enrich(late, *clinic(spark)))
    assert rows(judged, "error_message") == [("event_time is None",)]
