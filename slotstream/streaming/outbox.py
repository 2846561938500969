"""The notification consumer: topic to messages, hook and audit log."""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from slotstream.session import build_session, shared_dir
from slotstream.sources import topics
from slotstream.sources.tables import table
from slotstream.streaming import notifications
from slotstream.streaming.staging import run_all


def hook(name: str) -> notifications.Send:
    """The function `package.module:function`."""
    module, _, function = name.partition(":")
    return getattr(import_module(module), function)


def consumer(
    spark: SparkSession,
    messages: DataFrame,
    *,
    tables: str,
    root: str,
    send: notifications.Send,
    checkpoint: str,
) -> DataStreamWriter:
    """Notification messages settled below `root`. `tables` has patient, doctor_slot and doctor,
    which are looked into again for every micro-batch. Slots sorted or partitioned by `slot_id`, which
    begins with the date, are read only around those the batch names."""

    def references(session: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        return tuple(table(session, name, root=tables) for name in ("patient", "doctor_slot", "doctor"))

    write = notifications.outbox_writer(root, references, send=send)
    return notifications.outbox_stream(topics.notifications(messages), write, checkpoint)


def main() -> None:
    """Send what the notification topic asks for, once per key, and keep the audit log."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", default=notifications.TOPIC)
    parser.add_argument("--tables", required=True, help="folder of patient, doctor_slot and doctor")
    parser.add_argument("--root", required=True, help="folder of outbox and audit log")
    parser.add_argument("--send", required=True, metavar="MODULE:FUNCTION")
    parser.add_argument("--once", action="store_true")
    args = parser.parse_args()
    spark = build_session("notification-consumer")
    stream = consumer(
        spark,
        topics.stream(spark, args.topic, servers=args.servers, starting="latest"),
        tables=args.tables,
        root=args.root,
        send=hook(args.send),
        checkpoint=f"{shared_dir(spark)}/streams/notification_outbox",
    )
    run_all([stream], once=args.once)


if __name__ == "__main__":
    main()
