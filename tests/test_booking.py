"""Admission, cancellation and rebuild against one-at-a-time bookkeeping in plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from slotstream.operators import booking

SLOTS = "slot_id string, slot_status string, admin_status string"
REQUESTS = "request_id int, slot_id string, patient_id int, requested_at timestamp"
APPOINTMENTS = "appointment_id int, booking_ref string, slot_id string, patient_id int, booked_at timestamp"


def at(second):
    return dt.datetime(2026, 5, 1) + dt.timedelta(seconds=second)


def random_world(seed):
    rng = random.Random(seed)
    slots = [
        (f"S{i}", rng.choice(["AVAILABLE", "AVAILABLE", "BOOKED", "BLOCKED", "CANCELLED"]),
         rng.choice(["AVAILABLE"] * 4 + ["BLOCKED"]))
        for i in range(25)
    ]
    requests = [
        (i, rng.choice([None, "", f"S{rng.randrange(30)}"] + [f"S{rng.randrange(30)}"] * 6 + ["S1"] * 4),
         rng.choice([None, 0] + list(range(1, 9)) * 2), at(rng.randrange(40)))
        for i in range(120)
    ]
    return slots, requests


def one_at_a_time(slots, requests):
    state = {s: [status, admin] for s, status, admin in slots}
    verdicts, booked = {}, []
    for rid, sid, pid, when in sorted(requests, key=lambda r: (r[3], r[0])):
        if not sid or not pid:
            verdicts[rid] = "Missing slot_id or patient_id"
        elif sid not in state:
            verdicts[rid] = "Slot not found"
        elif state[sid][1] == "BLOCKED":
            verdicts[rid] = "Slot blocked by admin"
        elif state[sid][0] == "BLOCKED":
            verdicts[rid] = "That slot is blocked"
        elif state[sid][0] == "BOOKED":
            verdicts[rid] = "Slot already booked"
        else:
            verdicts[rid] = "Booked successfully"
            state[sid][0] = "BOOKED"
            booked.append((f"TXN26{10 + len(booked):08d}", 70 + len(booked), sid, pid, when))
    return verdicts, booked, state


@pytest.mark.parametrize("seed", [1, 2])
def test_admit_equals_one_at_a_time(spark, rows, seed):
    slots, requests = random_world(seed)
    verdicts, booked, state = one_at_a_time(slots, requests)
    out = booking.admit(
        spark.createDataFrame(requests, REQUESTS),
        spark.createDataFrame(slots, SLOTS),
        spark.createDataFrame([], APPOINTMENTS),
        first_transaction=10,
        first_appointment=70,
    )
    assert {r.request_id: r.message for r in out.verdicts.collect()} == verdicts
    assert rows(out.transactions, "transaction_id", "slot_id", "patient_id", "created_at") == sorted(
        (t, s, p, w) for t, _, s, p, w in booked
    )
    assert {(r.appointment_id, r.booking_ref, r.slot_id) for r in out.appointments.collect()} == {
        (a, t, s) for t, a, s, _, _ in booked
    }
    assert {r.slot_id: r.slot_status for r in out.slots.collect()} == {s: v[0] for s, v in state.items()}
    taken = [r.slot_id for r in out.appointments.collect()]
    assert len(taken) == len(set(taken))


def test_cancel(spark, rows):
    appointments = spark.createDataFrame(
        [(1, "T1", "S1", 1, at(0)), (2, "T2", "S2", 2, at(0))], APPOINTMENTS
    )
    patients = spark.createDataFrame([(1, "GD1"), (2, "GD2")], "patient_id int, insurance_number string")
    slots = spark.createDataFrame([("S1", "BOOKED", "AVAILABLE"), ("S2", "BOOKED", "AVAILABLE")], SLOTS)
    requests = spark.createDataFrame(
        [(1, "S1", "GD2", at(1)), (2, "S1", "GD1", at(3)), (3, "S1", "GD1", at(2)), (4, "S9", "GD1", at(1))],
        "request_id int, slot_id string, insurance_number string, requested_at timestamp",
    )
    out = booking.cancel(requests, slots, appointments, patients, first_transaction=5)
    assert rows(out.verdicts, "request_id", "message") == [
        (1, "Not your booking"),
        (2, "Not your booking"),
        (3, "Cancelled"),
        (4, "Not your booking"),
    ]
    assert rows(out.transactions, "transaction_id", "slot_id", "patient_id", "action") == [
        ("TXN2600000005", "S1", 1, "CANCELLED")
    ]
    assert rows(out.appointments, "appointment_id") == [(2,)]
    assert rows(out.slots, "slot_id", "slot_status") == [("S1", "AVAILABLE"), ("S2", "BOOKED")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rebuild_equals_a_fold(spark, rows, seed):
    rng = random.Random(seed)
    log = [
        (f"T{i:03d}", f"S{rng.randrange(12)}", rng.randrange(5) + 1,
         rng.choice(["BOOKED", "CANCELLED", "CONFIRMED"]), at(rng.randrange(30)))
        for i in range(100)
    ]
    live = {}
    for t, s, p, a, w in sorted(log, key=lambda r: (r[4], r[0])):
        live[s] = (t, s, p, w) if a == "BOOKED" else None
    df = spark.createDataFrame(
        log, "transaction_id string, slot_id string, patient_id int, action string, created_at timestamp"
    )
    assert rows(booking.rebuild_appointments(df.repartition(4))) == sorted(v for v in live.values() if v)


def test_one_wanted_slot(spark):
    """All requests name one slot: exactly one wins, and it is the first."""
    requests = spark.range(2000).select(
        F.col("id").cast("int").alias("request_id"),
        F.lit("S1").alias("slot_id"),
        F.lit(7).alias("patient_id"),
        F.timestamp_seconds(F.lit(5000) - F.col("id")).alias("requested_at"),
    )
    slots = spark.createDataFrame([("S1", "AVAILABLE", "AVAILABLE")], SLOTS)
    won = booking.judge_requests(requests, slots).filter("success").collect()
    assert [r.request_id for r in won] == [1999]
