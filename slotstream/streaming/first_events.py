"""Deduplication of events with a bounded memory that loses nothing.

The keys that went out are remembered by the day of their event, in folders that a batch reads only for
the days its own events have. Copies of an event carry its time, so they meet it in its day. Days
more than `keep` before the newest one seen in earlier batches are forgotten. An event of such a day
may be a first one or a copy of one forgotten: it goes to a table of its own, and `settle_late`
looks in all that went out to tell which. Every event is therefore sent, late, or a copy.

    root/horizon/dw_batch_id=4/             the oldest day remembered, fixed when the batch begins
    root/remembered/day=19810/dw_batch_id=4/
    root/sent/dw_batch_id=4/, root/late/dw_batch_id=4/

A repeated batch replaces its folders and does not see its own earlier keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from slotstream.operators import notify
from slotstream.operators.joins import lookup
from slotstream.session import delete, exists, materialise, names_in
from slotstream.sinks import writers

KEY, DAY = "notification_key", "day"
HORIZON = "oldest int, newest int"


def _horizon(spark: SparkSession, root: str, events: DataFrame, batch_id: int, keep: int) -> int | None:
    """The oldest day that is remembered in this batch; none before anything was seen."""
    path = f"{root}/horizon"
    own = writers.batch_folder(path, batch_id)
    if exists(spark, f"{own}/_SUCCESS"):
        return spark.read.schema(HORIZON).parquet(own).first().oldest
    before = [n for n in _numbers(spark, path) if n < batch_id and exists(spark, f"{writers.batch_folder(path, n)}/_SUCCESS")]
    seen = None
    if before:
        seen = spark.read.schema(HORIZON).parquet(writers.batch_folder(path, before[-1])).first().newest
    oldest = None if seen is None else seen - keep
    days = [d for d in (seen, events.agg(F.max(DAY)).first()[0]) if d is not None]
    row = [(oldest, max(days, default=None))]
    spark.createDataFrame(row, HORIZON).write.mode("overwrite").parquet(own)
    for n in before[:-1]:
        delete(spark, writers.batch_folder(path, n))
    return oldest


def _numbers(spark: SparkSession, path: str) -> list[int]:
    head = f"{writers.BATCH}="
    return sorted(int(n.removeprefix(head)) for n in names_in(spark, path) if n.startswith(head))


def _remembered(spark: SparkSession, root: str, events: DataFrame, batch_id: int) -> DataFrame:
    """Keys that earlier batches sent, of the days of `events`."""
    low, high = events.agg(F.min(DAY), F.max(DAY)).first()
    names = events.select(KEY, DAY, F.lit(0).alias(writers.BATCH))
    if low is None or not exists(spark, f"{root}/remembered"):
        return spark.createDataFrame([], names.schema).select(KEY)
    rows = spark.read.schema(names.schema).parquet(f"{root}/remembered")
    return rows.filter(F.col(DAY).between(low, high) & (F.col(writers.BATCH) < batch_id)).select(KEY)


def _remember(fresh: DataFrame, root: str, batch_id: int) -> None:
    """Adds a batch's keys to their days; the same batch written again replaces its own."""
    (
        fresh.select(KEY, DAY, F.lit(batch_id).alias(writers.BATCH))
        .hint("rebalance", DAY)
        .sortWithinPartitions(DAY, KEY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, writers.BATCH)
        .parquet(f"{root}/remembered")
    )


def forget(spark: SparkSession, root: str, oldest: int) -> list[int]:
    """Deletes the remembered keys of days before `oldest`."""
    days = [int(n.removeprefix(f"{DAY}=")) for n in names_in(spark, f"{root}/remembered") if n.startswith(f"{DAY}=")]
    gone = sorted(d for d in days if d < oldest)
    for day in gone:
        delete(spark, f"{root}/remembered/{DAY}={day}")
    return gone


def dedupe_writer(
    root: str,
    *,
    keep: int,
    event_time: str = "created_at",
    publish: Callable[[DataFrame, int], None] | None = None,
    on_metrics: Callable[[int, dict[str, int]], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function over events with a `notification_key`: the first of each key goes
    to `sent` (and to `publish`), events more than `keep` days old to `late`."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = materialise(batch.withColumn(DAY, F.unix_date(F.to_date(event_time))))
        oldest = _horizon(spark, root, events, batch_id, keep)
        behind = F.lit(False) if oldest is None else F.col(DAY) < oldest
        late = notify.dedupe(events.filter(behind))
        late_folder = writers.parquet_batch(late.drop(DAY), f"{root}/late", batch_id)
        first = materialise(notify.dedupe(events.filter(~behind)))
        known = _remembered(spark, root, first, batch_id)
        fresh = materialise(lookup(first, known.distinct(), [KEY], "left_anti").select(*first.columns))
        sent_folder = writers.parquet_batch(fresh.drop(DAY), f"{root}/sent", batch_id)
        sent = spark.read.schema(fresh.drop(DAY).schema).parquet(sent_folder)
        if publish:
            publish(sent, batch_id)
        _remember(fresh, root, batch_id)
        if oldest is not None:
            forget(spark, root, oldest)
        if on_metrics:
            n, n_sent = events.count(), sent.count()
            n_late = spark.read.parquet(late_folder).count()
            on_metrics(
                batch_id, {"arrived": n, "sent": n_sent, "late": n_late, "copies": n - n_sent - n_late}
            )

    return write_batch


def dedupe_stream(events: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    return (
        events.writeStream.outputMode("append")
        .queryName("first_events")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def settle_late(spark: SparkSession, root: str) -> DataFrame:
    """Of the events that came too late to be remembered, the first of each key that never went
    out. Looks in all that was sent, so it is for a job now and then."""
    batches = writers.finished_batches(spark, f"{root}/late", None)
    late = spark.read.parquet(*[writers.batch_folder(f"{root}/late", n) for n in batches])
    sent = spark.read.parquet(*[writers.batch_folder(f"{root}/sent", n) for n in batches]).select(KEY)
    return lookup(notify.dedupe(late), sent.distinct(), [KEY], "left_anti").select(*late.columns)
