"""Booking requests decided as they come: first come, first served over micro-batches.

The status of every slot is a state kept by slot (`sinks.keyed`). A micro-batch reads the parts in
which its slots lie, judges its requests as the batch form does, and rewrites only those parts. What
one batch books is taken for the next. Ids go on from batch to batch.

    root/verdicts/dw_batch_id=4/       one row per request
    root/transactions/, root/appointments/
    root/slots/                        state; a fold for every batch
    root/numbers/upto=5/               transactions and appointments given out so far

Every step writes a folder of the batch's own and starts from what stood before it, so a repeated
batch gives the same rows, whatever part of it was done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from slotstream.operators import booking, latest
from slotstream.operators.joins import lookup
from slotstream.session import materialise
from slotstream.sinks import keyed, writers

VERSION = "_version"
NUMBERS = "transactions long, appointments long"
APPOINTMENTS = "appointment_id int, booking_ref string, slot_id string, patient_id int, booked_at timestamp"


def _newest(rows: DataFrame) -> DataFrame:
    return latest.replace_latest(rows, ["slot_id"], [VERSION])


def open_slots(
    slots: DataFrame,
    root: str,
    *,
    first_transaction: int = 1,
    first_appointment: int = 1,
    parts: int = keyed.PARTS,
) -> None:
    """The state before the first batch: all slots, and the numbers ids begin with."""
    rows = slots.withColumn(VERSION, F.lit(0).cast("long"))
    keyed.fold(rows, f"{root}/slots", ["slot_id"], _newest, 0, parts=parts, base=-1)
    _write_numbers(slots.sparkSession, root, 0, first_transaction - 1, first_appointment - 1)


def _write_numbers(spark: SparkSession, root: str, upto: int, *given: int) -> None:
    spark.createDataFrame([given], NUMBERS).write.mode("overwrite").parquet(
        f"{root}/numbers/{writers.UPTO}{upto}"
    )


def slots_now(spark: SparkSession, root: str, columns: DataFrame) -> DataFrame:
    """All slots as they stand after the last batch; `columns` is any frame with their columns."""
    schema = columns.withColumn(VERSION, F.lit(0).cast("long")).schema
    return keyed.read(spark, f"{root}/slots", schema).drop(VERSION)


def admission_writer(root: str, slots: DataFrame) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that books what can be booked of a batch of requests
    `(request_id, slot_id, patient_id, requested_at)`. `slots` tells the columns of the state."""
    state = f"{root}/slots"
    schema = slots.withColumn(VERSION, F.lit(0).cast("long")).schema

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        requests = materialise(batch)
        parts = keyed.manifest(spark, state, batch_id)[1]
        touched = [r[0] for r in requests.select(keyed.part_of(["slot_id"], parts)).distinct().collect()]
        near = keyed.read(spark, state, schema, parts=touched, at=batch_id)
        wanted = latest.unique_keys(requests, ["slot_id"])
        named = materialise(lookup(near, wanted, ["slot_id"], "left_semi")).drop(VERSION)
        given = spark.read.schema(NUMBERS).parquet(f"{root}/numbers/{writers.UPTO}{batch_id}").first()
        done = booking.admit(
            requests,
            named,
            spark.createDataFrame([], APPOINTMENTS),
            first_transaction=given.transactions + 1,
            first_appointment=given.appointments + 1,
        )
        writers.parquet_batch(done.verdicts, f"{root}/verdicts", batch_id)
        folder = writers.parquet_batch(done.transactions, f"{root}/transactions", batch_id)
        writers.parquet_batch(done.appointments, f"{root}/appointments", batch_id)
        booked = spark.read.schema(done.transactions.schema).parquet(folder)
        n = booked.count()
        changed = lookup(done.slots, booked.select("slot_id"), ["slot_id"], "left_semi")
        changed = changed.withColumn(VERSION, F.lit(batch_id + 1).cast("long")).select(*schema.names)
        keyed.fold(changed, state, ["slot_id"], _newest, batch_id + 1, base=batch_id)
        _write_numbers(spark, root, batch_id + 1, given.transactions + n, given.appointments + n)
        keyed.expire(spark, state)

    return write_batch


def admission_stream(
    requests: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    return (
        requests.writeStream.outputMode("append")
        .queryName("booking_admission")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
