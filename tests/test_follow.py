"""Facts that follow their slots, run by run, against slots looked up in the end."""

import random

from slotstream.operators import warehouse
from slotstream.plans import follow
from slotstream.plans import warehouse as plan
from slotstream.sinks import keyed, writers
from slotstream.streaming import staging

FACT = "fact_appointment"
SLOT = "slot_id string, doctor_id string, slot_date date, slot_code string, is_deleted int, cdc_ts timestamp, " \
       "source_partition int, source_offset long"
BOOKING = "appointment_id long, booking_ref string, slot_id string, patient_id long, booked_at timestamp, " \
          "is_deleted int, cdc_ts timestamp, source_offset long"


def feeder(spark, root, ts):
    def at(offset):
        return ts(f"2026-01-01 00:{offset // 60:02}:{offset % 60:02}")

    def slots(batch, *data):
        """(slot, doctor, offset); without a doctor it is deleted."""
        rows = [(s, d, None, f"C{o}", int(d is None), at(o), 0, o) for s, d, o in data]
        writers.parquet_batch(spark.createDataFrame(rows, SLOT), staging.slot_path(root), batch)

    def bookings(batch, *data, known=True):
        """(appointment, slot, offset); `known`: with what is known of the slot by now."""
        rows = [(a, f"B{o}", s, 1, at(o), 0, at(o), o) for a, s, o in data]
        stg = spark.createDataFrame(rows, BOOKING)
        found = staging.slots_of(stg, root)
        facts = warehouse.fact_appointment(stg, found if known else found.limit(0))
        writers.parquet_batch(facts, f"{root}/{FACT}", batch)

    return slots, bookings


def views(spark, root):
    """The current view of the tables alone, and with slots looked up again."""
    facts = spark.read.parquet(f"{root}/{FACT}").drop(writers.BATCH)
    found = plan.current_views({FACT: follow.with_corrections(spark, facts, root, FACT)})
    slots = warehouse.slot_attributes(spark.read.parquet(staging.slot_path(root)))
    wanted = plan.current_views({FACT: facts}, slots)
    columns = ["appointment_id", "booking_ref", "slot_id", "doctor_id", "slot_code", "latest_dw_updated_at"]
    name = f"vw_{FACT}_current"
    return [sorted(map(tuple, x[name].select(*columns).collect()), key=str) for x in (found, wanted)]


def test_facts_follow(spark, tmp_path, ts):
    root = str(tmp_path)
    slots, bookings = feeder(spark, root, ts)
    assert follow.follow(spark, root, FACT) is None
    bookings(0, (1, "S1", 1), (2, "S2", 2), (3, None, 3))
    assert follow.follow(spark, root, FACT) == 0
    slots(0, ("S1", "A", 5), ("S9", "B", 6))
    assert follow.follow(spark, root, FACT) == 1 and follow.follow(spark, root, FACT) is None
    got, wanted = views(spark, root)
    assert got == wanted and [x[3] for x in got] == ["A", "", ""]
    # a later version of a booking that an earlier correction must not hide, and one on another slot
    bookings(1, (1, "S1", 3), (2, "S9", 4))
    slots(1, ("S1", "C", 7), ("S2", "D", 8))
    assert follow.follow(spark, root, FACT) == 2
    got, wanted = views(spark, root)
    assert got == wanted and [x[1:4] for x in got] == [("B3", "S1", "C"), ("B4", "S9", "B"), ("B3", None, "")]
    # an older version of the slot, and a delete that carries the key alone, change nothing
    slots(2, ("S1", "X", 4), ("S2", None, 9))
    assert follow.follow(spark, root, FACT) == 3
    last = spark.read.parquet(writers.batch_folder(follow.corrections_path(root, FACT), 3))
    assert last.count() == 0 and views(spark, root)[0] == got


def test_a_failed_run_is_done_again(spark, tmp_path, ts):
    root = str(tmp_path)
    slots, bookings = feeder(spark, root, ts)
    bookings(0, (1, "S1", 1), (2, "S2", 1))
    follow.follow(spark, root, FACT)
    slots(0, ("S1", "A", 5))
    follow.follow(spark, root, FACT)
    (tmp_path / f"{FACT}_follow/upto=1/_SUCCESS").unlink()
    slots(1, ("S2", "B", 6))
    assert follow.follow(spark, root, FACT) == 1
    got, wanted = views(spark, root)
    assert got == wanted and [x[3] for x in got] == ["A", "B"]


def test_random_runs(spark, tmp_path, ts):
    """Facts and slots in any order, some facts written before a slot that was there already."""
    draw, root = random.Random(2), str(tmp_path)
    slots, bookings = feeder(spark, root, ts)
    offset = 0
    for batch in range(4):
        for write, n in ((slots, 6), (bookings, 12)):
            some = [(draw.randrange(20), f"S{draw.randrange(9)}", offset + k) for k in range(n)]
            offset += n
            if write is slots:
                slots(batch, *[(s, f"D{a}", o) for a, s, o in some])
            else:
                bookings(batch, *some, known=draw.random() < 0.5)
        if batch != 1:
            follow.follow(spark, root, FACT, parts=4)
    got, wanted = views(spark, root)
    assert got == wanted and len(got) > 10
    folder = f"{root}/{FACT}_by_slot"
    schema = spark.read.parquet(writers.batch_folder(f"{root}/{FACT}", 0)).schema
    part = keyed.read(spark, folder, schema, parts=[0])
    assert 0 < part.count() < keyed.read(spark, folder, schema).count()
