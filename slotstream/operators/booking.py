"""Bookings: admission, cancellation, rebuild from the log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotstream.functions import status, text
from slotstream.operators import latest
from slotstream.operators.joins import lookup
from slotstream.operators.numbering import number_rows
from slotstream.session import materialise

# fixed values: transaction ids, and the outcomes of requests
TRANSACTION_PREFIX, TRANSACTION_WIDTH = "TXN26", 8
MISSING = "Missing slot_id or patient_id"
NOT_FOUND = "Slot not found"
ADMIN_BLOCKED = "Slot blocked by admin"
BLOCKED = "That slot is blocked"
TAKEN = "Slot already booked"
BOOKED = "Booked successfully"
CANCELLED = "Cancelled"
NOT_YOURS = "Not your booking"


@dataclass(frozen=True)
class Outcome:
    """Verdict per request, the log entries to add, and the two tables afterwards."""

    verdicts: DataFrame
    transactions: DataFrame
    appointments: DataFrame
    slots: DataFrame


def judge_requests(requests: DataFrame, slots: DataFrame) -> DataFrame:
    """Verdict of each request `(request_id, slot_id, patient_id, requested_at)`.

    Whether a slot can be booked depends on the slot alone, so of the complete requests for
    one slot the first by `(requested_at, request_id)` gets it. The first is found by an
    aggregate that combines before the shuffle and is joined back on the unique request id:
    a slot everybody wants puts no more than its rows of one task into any group.
    """
    complete = status.filled(F.col("slot_id")) & status.present(F.col("patient_id"))
    firsts = (
        requests.filter(complete)
        .groupBy("slot_id")
        .agg(F.min_by("request_id", F.struct("requested_at", "request_id")).alias("request_id"))
        .select("request_id", F.lit(True).alias("_first"))
    )
    known = slots.select("slot_id", "slot_status", "admin_status", F.lit(True).alias("_known"))
    message = (
        F.when(~complete, F.lit(MISSING))
        .when(F.col("_known").isNull(), F.lit(NOT_FOUND))
        .when(F.col("admin_status") == "BLOCKED", F.lit(ADMIN_BLOCKED))
        .when(F.col("slot_status") == "BLOCKED", F.lit(BLOCKED))
        .when(F.col("slot_status") == "BOOKED", F.lit(TAKEN))
        .when(F.col("_first"), F.lit(BOOKED))
        .otherwise(F.lit(TAKEN))
    )
    return (
        lookup(requests, known, ["slot_id"])
        .join(firsts, "request_id", "left")
        .withColumn("message", message)
        .withColumn("success", F.col("message") == BOOKED)
        .select(*requests.columns, "success", "message")
    )


def _log(entries: DataFrame, action: str, first: int) -> DataFrame:
    number = F.col("_number") + F.lit(first - 1)
    return entries.select(
        text.sequence_id(TRANSACTION_PREFIX, number, TRANSACTION_WIDTH).alias("transaction_id"),
        "slot_id",
        "patient_id",
        F.lit(action).alias("action"),
        F.col("requested_at").alias("created_at"),
    )


def _set_status(slots: DataFrame, slot_ids: DataFrame, value: str) -> DataFrame:
    hit = latest.unique_keys(slot_ids, ["slot_id"]).withColumn("_hit", F.lit(True))
    state = F.when(F.col("_hit"), F.lit(value)).otherwise(F.col("slot_status"))
    return slots.join(hit, "slot_id", "left").withColumn("slot_status", state).select(*slots.columns)


def admit(
    requests: DataFrame,
    slots: DataFrame,
    appointments: DataFrame,
    *,
    first_transaction: int = 1,
    first_appointment: int = 1,
) -> Outcome:
    """Book what can be booked. Ids continue from the given numbers in request order.

    The verdicts are written once; everything else follows from them.
    """
    verdicts = materialise(judge_requests(requests, slots))
    won = number_rows(
        verdicts.filter("success").select("request_id", "slot_id", "patient_id", "requested_at"),
        ["requested_at", "request_id"],
        "_number",
    )
    added = won.select(
        (F.col("_number") + F.lit(first_appointment - 1)).cast("int").alias("appointment_id"),
        text.sequence_id(
            TRANSACTION_PREFIX, F.col("_number") + F.lit(first_transaction - 1), TRANSACTION_WIDTH
        ).alias("booking_ref"),
        "slot_id",
        "patient_id",
        F.col("requested_at").alias("booked_at"),
    )
    return Outcome(
        verdicts,
        _log(won, "BOOKED", first_transaction),
        appointments.unionByName(added),
        _set_status(slots, won, "BOOKED"),
    )


def judge_cancellations(
    requests: DataFrame, appointments: DataFrame, patients: DataFrame
) -> DataFrame:
    """Verdict of each request `(request_id, slot_id, insurance_number, requested_at)`.

    A booking is cancelled by the first request that names its slot and the insurance
    number of its patient; there is nothing left to cancel for the later ones.
    """
    owned = appointments.select("appointment_id", "slot_id", "patient_id").join(
        patients.select("patient_id", "insurance_number"), "patient_id"
    )
    matches = requests.select("request_id", "requested_at", "slot_id", "insurance_number").join(
        owned, ["slot_id", "insurance_number"]
    )
    firsts = matches.groupBy("appointment_id").agg(
        F.min_by(F.struct("request_id", "patient_id"), F.struct("requested_at", "request_id")).alias("_w")
    )
    won = firsts.select("appointment_id", "_w.request_id", "_w.patient_id")
    success = F.col("appointment_id").isNotNull()
    return (
        requests.join(won, "request_id", "left")
        .withColumn("success", success)
        .withColumn("message", F.when(success, F.lit(CANCELLED)).otherwise(F.lit(NOT_YOURS)))
        .select(*requests.columns, "appointment_id", "patient_id", "success", "message")
    )


def cancel(
    requests: DataFrame,
    slots: DataFrame,
    appointments: DataFrame,
    patients: DataFrame,
    *,
    first_transaction: int = 1,
) -> Outcome:
    """Cancel what the requester owns: log it, delete the booking, free the slot.

    The verdicts are written once; everything else follows from them.
    """
    verdicts = materialise(judge_cancellations(requests, appointments, patients))
    won = number_rows(
        verdicts.filter("success").select(
            "request_id", "appointment_id", "slot_id", "patient_id", "requested_at"
        ),
        ["requested_at", "request_id"],
        "_number",
    )
    return Outcome(
        verdicts,
        _log(won, "CANCELLED", first_transaction),
        appointments.join(won.select("appointment_id"), "appointment_id", "left_anti"),
        _set_status(slots, won, "AVAILABLE"),
    )


def rebuild_appointments(transactions: DataFrame) -> DataFrame:
    """Live bookings from the log: slots whose last entry is BOOKED.

    The last entry is found first and looked at second; entries of one instant count by id.
    """
    newest = latest.replace_latest(
        transactions.select("transaction_id", "slot_id", "patient_id", "action", "created_at"),
        ["slot_id"],
        ["created_at", "transaction_id"],
    )
    return newest.filter(F.col("action") == "BOOKED").select(
        F.col("transaction_id").alias("booking_ref"),
        "slot_id",
        "patient_id",
        F.col("created_at").alias("booked_at"),
    )
