"""Bounded deduplication that loses nothing, and bookings decided batch by batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from slotstream.operators import booking
from slotstream.session import names_in
from slotstream.sinks import keyed, writers
from slotstream.streaming import bookings, first_events

EVENT = "notification_key string, cdc_ts timestamp, source_partition int, source_offset long, created_at timestamp"


def table(spark, path):
    return spark.read.parquet(path).drop(writers.BATCH)


@pytest.fixture
def events(spark):
    def make(*rows):
        """(key, day of January, offset)"""
        data = [(k, dt.datetime(2026, 1, 1), 0, o, dt.datetime(2026, 1, d, 12)) for k, d, o in rows]
        return spark.createDataFrame(data, EVENT)

    return make


def test_every_event_is_sent_late_or_a_copy(spark, tmp_path, events):
    root, counts = str(tmp_path), {}
    write = first_events.dedupe_writer(root, keep=5, on_metrics=counts.__setitem__)
    write(events(("a", 10, 1), ("a", 10, 2), ("b", 3, 3)), 0)
    write(events(("b", 3, 4), ("c", 9, 5), ("d", 20, 6)), 1)
    # from here on days before the 15th are forgotten
    write(events(("a", 10, 7), ("e", 12, 8), ("e", 12, 9), ("f", 16, 10), ("d", 20, 11)), 2)
    assert counts[0] == {"arrived": 3, "sent": 2, "late": 0, "copies": 1}
    assert counts[1] == {"arrived": 3, "sent": 2, "late": 1, "copies": 0}
    assert counts[2] == {"arrived": 5, "sent": 1, "late": 2, "copies": 2}
    sent = sorted(r.notification_key for r in table(spark, f"{root}/sent").collect())
    assert sent == ["a", "b", "c", "d", "f"]
    assert sorted(r.notification_key for r in table(spark, f"{root}/late").collect()) == ["a", "b", "e"]
    assert [r.notification_key for r in first_events.settle_late(spark, root).collect()] == ["e"]
    days = [n for n in names_in(spark, f"{root}/remembered") if n.startswith("day=")]
    epoch = dt.date(1970, 1, 1)
    assert sorted(days) == [f"day={(dt.date(2026, 1, d) - epoch).days}" for d in (16, 20)]


def test_a_repeated_batch_gives_the_same(spark, tmp_path, events):
    root = str(tmp_path)
    write = first_events.dedupe_writer(root, keep=5)
    batches = [events(("a", 10, 1)), events(("a", 10, 2), ("b", 30, 3)), events(("a", 10, 4), ("c", 29, 5))]
    seen = []
    for n, batch in enumerate(batches):
        for _ in range(2):
            write(batch, n)
            seen.append(
                [sorted(r.notification_key for r in table(spark, f"{root}/{t}").collect()) for t in ("sent", "late")]
            )
    assert seen[0::2] == seen[1::2]
    assert seen[-1] == [["a", "b", "c"], ["a"]]
    write(batches[0].limit(0), 3)
    assert first_events.settle_late(spark, root).count() == 0


SLOT = "slot_id string, doctor_id string, slot_status string, admin_status string"
REQUEST = "request_id long, slot_id string, patient_id int, requested_at timestamp"


def test_bookings_batch_by_batch(spark, tmp_path):
    """One slot that everybody wants; each batch is written twice, and only its parts change."""
    root, draw = str(tmp_path), random.Random(4)
    status = ["AVAILABLE", "AVAILABLE", "BOOKED", "BLOCKED"]
    slots = spark.createDataFrame(
        [(f"S{i}", "D", draw.choice(status), draw.choice(["AVAILABLE", "AVAILABLE", "BLOCKED"])) for i in range(300)]
        + [("HOT", "D", "AVAILABLE", "AVAILABLE")],
        SLOT,
    )
    start = dt.datetime(2026, 1, 1)
    made = [
        (
            i,
            draw.choice(["HOT", None, "GONE", *[f"S{draw.randrange(300)}" for _ in range(4)]]),
            draw.choice([None, 0, 5, 6, 7]),
            start + dt.timedelta(seconds=i // 2),
        )
        for i in range(160)
    ]
    bookings.open_slots(slots, root, first_transaction=11, first_appointment=21, parts=8)
    write = bookings.admission_writer(root, slots)
    for n in range(4):
        batch = spark.createDataFrame(made[40 * n : 40 * n + 40], REQUEST)
        write(batch, n)
        write(batch, n)
    write(spark.createDataFrame([], REQUEST), 4)
    empty = spark.createDataFrame([], bookings.APPOINTMENTS)
    whole = booking.admit(
        spark.createDataFrame(made, REQUEST), slots, empty, first_transaction=11, first_appointment=21
    )
    for name in ("verdicts", "transactions", "appointments"):
        wanted = getattr(whole, name)
        got = table(spark, f"{root}/{name}").select(*wanted.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    now = bookings.slots_now(spark, root, slots)
    assert sorted(map(str, now.collect())) == sorted(map(str, whole.slots.select(*now.columns).collect()))
    assert table(spark, f"{root}/verdicts").filter(F.col("slot_id") == "HOT").filter("success").count() == 1
    before = keyed.manifest(spark, f"{root}/slots", 5)[0]
    write(spark.createDataFrame([(999, "S1", 5, start)], REQUEST), 5)
    after = keyed.manifest(spark, f"{root}/slots", 6)[0]
    assert sum(after[p] != before[p] for p in after) <= 1
