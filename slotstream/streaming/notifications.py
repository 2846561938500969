"""Booking log to notification topic, and notification topic to outbox and audit log."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from slotstream.operators import cdc, notify
from slotstream.operators.joins import named
from slotstream.session import build_session, materialise, shared_dir
from slotstream.sinks import writers
from slotstream.sources import topics
from slotstream.sources.registry import DEFAULT_TOPIC_PREFIX, NOTIFICATION_SCHEMA, TABLES

LOG = TABLES["appointment_transaction"]
# fixed value: the environment variable that holds the cut-off, and the topic written
START_VARIABLE = "SYSTEM_START_TIME"
TOPIC = "notification.booking_event"

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.TimestampType() if f.name == "event_time" else f.dataType)
        for f in NOTIFICATION_SCHEMA
    ]
    + [
        T.StructField("send_status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("sent_at", T.TimestampType()),
    ]
)

# what tells whether a key was sent
SENT_SCHEMA = T.StructType([AUDIT_SCHEMA["notification_key"], AUDIT_SCHEMA["send_status"]])


def _sent_once(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("send_status") == "SENT").distinct()


# gets the messages to send; returns (notification_key, error_message) of those that failed
Send = Callable[[DataFrame], DataFrame | None]


def event_stream(
    messages: DataFrame,
    since: Column,
    *,
    delay: str = "10 minutes",
    within_watermark: bool = False,
    salts: int = 8,
) -> DataFrame:
    """Notification messages `(key, value)` from the change topic of the booking log.

    Nothing is ever forgotten and nothing is late. With `within_watermark=True` the state is
    bounded; events behind the watermark are dropped along with the copies then, and the
    progress reports count them.
    """
    rows = cdc.decode(messages, LOG)
    events = notify.booking_events(rows, since)
    return notify.to_messages(
        notify.dedupe(events, delay=delay, within_watermark=within_watermark, salts=salts)
    )


def only_named(
    events: DataFrame, patients: DataFrame, slots: DataFrame, doctors: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of the reference tables what a batch of events names. `events` and the slots found are read
    more than once; the slots are written for that."""
    placed = materialise(named(slots.select("slot_id", "slot_date", "slot_code", "doctor_id"), events, "slot_id"))
    return named(patients, events, "patient_id"), placed, named(doctors, placed, "doctor_id")


def outbox_writer(
    root: str,
    references: Callable[[SparkSession], tuple[DataFrame, DataFrame, DataFrame]],
    *,
    send: Send | None = None,
    now: Column | None = None,
    fold_every: int = writers.FOLD_EVERY,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that settles notification events.

    Each step goes to the batch's own folder below `root`: `events`, `judged`, `outbox`,
    `audit_pending`, `audit`, and the next step starts from there, so the source is read
    once. PENDING rows are written before `send` is called, SENT and FAILED rows after it. A
    repeated batch replaces its folders and ignores its own earlier audit rows; it then sends
    again, so delivery is at least once. `references` gives patients, slots and doctors, of which
    only the rows that the batch names are taken into joins. Every
    `fold_every` batches the keys sent so far become a state, from which they are looked up.
    """
    clock = F.current_timestamp() if now is None else now
    key = ["notification_key"]

    def earlier_audit(spark: SparkSession, events: DataFrame, batch_id: int) -> DataFrame:
        """Audit rows of earlier batches, of keys in the range of this one.

        Keys are numbered upwards and the files are sorted by them, so the range keeps most
        of the state from being read.
        """
        path = f"{root}/audit"
        writers.fold(spark, SENT_SCHEMA, path, _sent_once, batch_id, sort_by=key, every=fold_every)
        low, high = events.agg(F.min(*key), F.max(*key)).first()
        rows = writers.recent(spark, SENT_SCHEMA, path, last=batch_id - 1)
        return rows.filter(F.col(*key).between(F.lit(low), F.lit(high)))

    def step(df: DataFrame, name: str, batch_id: int) -> DataFrame:
        folder = writers.parquet_batch(df, f"{root}/{name}", batch_id, sort_by=key)
        return df.sparkSession.read.schema(df.schema).parquet(folder)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = step(batch, "events", batch_id)
        patients, slots, doctors = only_named(events, *references(spark))
        audit = earlier_audit(spark, events, batch_id)
        judged = step(notify.outbox(events, audit, patients, slots, doctors), "judged", batch_id)
        sendable = judged.filter(F.col("error_message") == "")
        step(notify.audit_rows(sendable, F.lit("PENDING"), clock), "audit_pending", batch_id)
        mails = step(notify.outgoing(judged), "outbox", batch_id)
        failed = send(mails) if send else None
        if failed is not None:
            failures = failed.select(*key, F.col("error_message").alias("_failure"))
            judged = judged.join(failures, key, "left").withColumn(
                "error_message", F.coalesce("_failure", "error_message")
            )
        outcome = F.when(F.col("error_message") == "", F.lit("SENT")).otherwise(F.lit("FAILED"))
        step(notify.audit_rows(judged, outcome, clock), "audit", batch_id)

    return write_batch


def outbox_stream(
    events: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    return (
        events.writeStream.outputMode("append")
        .queryName("notification_outbox")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def start_time(value: str | None = None) -> Column:
    """The cut-off: events of bookings made earlier are not sent. There is no default."""
    given = value or os.environ.get(START_VARIABLE)
    if not given:
        raise RuntimeError(f"{START_VARIABLE} is not set")
    return F.to_timestamp(F.lit(given))


def main() -> None:
    """Booking events to the notification topic."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic-prefix", default=DEFAULT_TOPIC_PREFIX)
    parser.add_argument("--topic", default=TOPIC)
    parser.add_argument(
        "--forget-after",
        metavar="DELAY",
        help="bounded state: forget keys after this time, and drop events that come later than it",
    )
    args = parser.parse_args()
    spark = build_session("booking-notifications")
    bounded = {"delay": args.forget_after, "within_watermark": True} if args.forget_after else {}
    source = topics.stream(
        spark, LOG.topic(args.topic_prefix), servers=args.servers, starting="latest"
    )
    query = writers.topic_writer(
        event_stream(source, start_time(), **bounded),
        args.topic,
        checkpoint=f"{shared_dir(spark)}/streams/notification_booking_event",
        servers=args.servers,
    ).start()
    query.awaitTermination()


if __name__ == "__main__":
    main()
