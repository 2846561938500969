"""Booking events to notifications: selection, duplicates, enrichment, messages, audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotstream.functions import messages, status, text
from slotstream.operators import latest
from slotstream.operators.joins import lookup

# fixed values: the channel, the actions that notify, and the reasons for a failure
CHANNEL = "EMAIL"
NOTIFY_ACTIONS = ["BOOKED", "CANCELLED"]
NO_DETAILS = "Cannot find booking details for notification"
NO_EMAIL = "Patient email is null"
NO_EVENT_TIME = "event_time is None"

EVENT_COLUMNS = [
    "notification_key",
    "transaction_id",
    "slot_id",
    "patient_id",
    "action",
    "event_type",
    "event_time",
    "channel",
]
AUDIT_COLUMNS = [*EVENT_COLUMNS, "send_status", "error_message", "processed_at", "sent_at"]


def booking_events(transactions: DataFrame, since: Column) -> DataFrame:
    """Log entries that notify: not deleted, booked or cancelled, created at or after `since`."""
    kind = messages.event_type(F.col("action"))
    return (
        transactions.filter(
            (F.col("is_deleted") == 0)
            & F.col("action").isin(NOTIFY_ACTIONS)
            & (F.col("created_at") >= since)
        )
        .withColumns(
            {
                "event_type": kind,
                "notification_key": F.col("transaction_id"),
                "channel": F.lit(CHANNEL),
            }
        )
        .filter(F.col("event_type").isNotNull())
    )


def dedupe(
    events: DataFrame,
    *,
    ts: str = "cdc_ts",
    delay: str = "10 minutes",
    within_watermark: bool = False,
    salts: int = 8,
    order: tuple[str, ...] = ("cdc_ts", "source_partition", "source_offset"),
) -> DataFrame:
    """One event per `notification_key`.

    On a stream keys are remembered for ever, so a first event is never late, however old it
    is. With `within_watermark=True` they are remembered for the watermark delay: the state
    stays bounded, but first events behind the watermark are dropped along with the copies, and
    whoever chooses it must bring them in again another way. Copies of a key are first dropped in `salts` separate groups, so a
    key repeated without end is not worked through by one task (`salts=1` leaves that out).
    In a batch the earliest event of each key is kept.
    """
    if events.isStreaming:
        rows = events.withWatermark(ts, delay) if within_watermark else events
        key = ["notification_key"]
        if salts > 1:
            salt = F.pmod(F.xxhash64(*events.columns), F.lit(salts))
            rows = _drop_copies(rows.withColumn("_salt", salt), [*key, "_salt"], within_watermark)
            rows = rows.drop("_salt")
        return _drop_copies(rows, key, within_watermark)
    rest = [c for c in events.columns if c != "notification_key"]
    position = [c for c in order if c in events.columns] or rest
    return (
        events.groupBy("notification_key")
        .agg(F.min_by(F.struct(*rest), F.struct(*position)).alias("_row"))
        .select("notification_key", "_row.*")
        .select(*events.columns)
    )


def _drop_copies(rows: DataFrame, keys: list[str], within_watermark: bool) -> DataFrame:
    if within_watermark:
        return rows.dropDuplicatesWithinWatermark(keys)
    return rows.dropDuplicates(keys)


def to_messages(events: DataFrame) -> DataFrame:
    """Topic messages `(key, value)`: the event as JSON with its time as `event_time`."""
    fields = [
        F.col("created_at").alias("event_time") if c == "event_time" else F.col(c)
        for c in EVENT_COLUMNS
    ]
    return events.select(
        F.col("notification_key").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )


def not_yet_sent(events: DataFrame, audit: DataFrame) -> DataFrame:
    """Events without a SENT row in the audit log."""
    sent = latest.unique_keys(audit.filter(F.col("send_status") == "SENT"), ["notification_key"])
    return lookup(events, sent, ["notification_key"], "left_anti").select(*events.columns)


def enrich(
    events: DataFrame, patients: DataFrame, slots: DataFrame, doctors: DataFrame
) -> DataFrame:
    """Events with patient, slot and doctor columns; `found` where all three are known."""
    who = patients.select("patient_id", "patient_name", "email", F.lit(True).alias("_patient"))
    where = slots.select("slot_id", "slot_date", "slot_code", "doctor_id")
    whom = doctors.select("doctor_id", "doctor_name", "specialty", F.lit(True).alias("_doctor"))
    placed = lookup(events, where, ["slot_id"])
    joined = lookup(lookup(placed, who, ["patient_id"]), whom, ["doctor_id"])
    found = F.coalesce(F.col("_patient") & F.col("_doctor"), F.lit(False))
    return joined.withColumn("found", found).select(
        *events.columns,
        "patient_name",
        "email",
        "slot_date",
        "slot_code",
        "doctor_name",
        "specialty",
        "found",
    )


def judge(enriched: DataFrame) -> DataFrame:
    """Adds `error_message`: empty where the notification can go out."""
    reason = (
        F.when(~F.col("found"), F.lit(NO_DETAILS))
        .when(~status.filled(F.col("email")), F.lit(NO_EMAIL))
        .when(text.parse_event_time(F.col("event_time")).isNull(), F.lit(NO_EVENT_TIME))
        .otherwise(F.lit(""))
    )
    return enriched.withColumn("error_message", reason)


def outgoing(judged: DataFrame) -> DataFrame:
    """Messages to send: recipient, subject and body per notification."""
    kind = F.col("event_type")
    return judged.filter(F.col("error_message") == "").select(
        "notification_key",
        F.col("email").alias("recipient"),
        messages.subject(kind).alias("subject"),
        messages.body(
            kind,
            F.col("patient_name"),
            F.col("slot_date"),
            F.col("slot_code"),
            F.col("doctor_name"),
            F.col("specialty"),
        ).alias("body"),
    )


def audit_rows(events: DataFrame, send_status: Column, now: Column) -> DataFrame:
    """Audit rows for judged events; only SENT rows carry a sending time."""
    return events.select(
        *[
            text.parse_event_time(F.col(c)).alias(c) if c == "event_time" else F.col(c)
            for c in EVENT_COLUMNS
        ],
        send_status.alias("send_status"),
        F.when(send_status == "FAILED", F.col("error_message")).otherwise(F.lit("")).alias("error_message"),
        now.alias("processed_at"),
        F.when(send_status == "SENT", now).alias("sent_at"),
    )


def outbox(
    events: DataFrame,
    audit: DataFrame,
    patients: DataFrame,
    slots: DataFrame,
    doctors: DataFrame,
) -> DataFrame:
    """Judged events still to be handled: one per key, none that was sent before."""
    once = dedupe(events, order=("event_time", "transaction_id"))
    return judge(enrich(not_yet_sent(once, audit), patients, slots, doctors))


def settle(judged: DataFrame, now: Column) -> DataFrame:
    """The audit trail of judged events: PENDING and SENT if sendable, else FAILED."""
    states = F.when(
        F.col("error_message") == "", F.array(F.lit("PENDING"), F.lit("SENT"))
    ).otherwise(F.array(F.lit("FAILED")))
    return audit_rows(judged.withColumn("_state", F.explode(states)), F.col("_state"), now)
