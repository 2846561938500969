"""Calendar, preview, generation, merge, cascade, slot lists and slot updates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slotstream.functions import calendar, status, text
from slotstream.operators import schedule, slots
from slotstream.plans import monthly

SLOTS = (
    "slot_id string, doctor_id string, slot_date date, slot_code string, slot_status string, admin_status string"
)
D = dt.date


def slot(doctor, day, code, state="AVAILABLE", admin="AVAILABLE"):
    return (f"{day:%Y%m%d}{doctor}{code}", doctor, day, code, state, admin)


def test_calendar(spark):
    days = schedule.calendar_days(spark)
    assert days.count() == 9131
    picked = {
        r.date: (r.status, r.weekday_name)
        for r in days.filter("date between '2026-04-26' and '2026-05-03'").collect()
    }
    assert picked == {
        D(2026, 4, 26): ("WEEKEND", "SUN"),
        D(2026, 4, 27): ("NORMAL_DAY", "MON"),
        D(2026, 4, 28): ("NORMAL_DAY", "TUE"),
        D(2026, 4, 29): ("NORMAL_DAY", "WED"),
        D(2026, 4, 30): ("HOLIDAY", "THU"),
        D(2026, 5, 1): ("HOLIDAY", "FRI"),
        D(2026, 5, 2): ("NORMAL_DAY", "SAT"),
        D(2026, 5, 3): ("WEEKEND", "SUN"),
    }
    ranged = schedule.calendar_range(days, D(2026, 1, 1), D(2026, 1, 3)).collect()
    assert [r.date.day for r in ranged] == [1, 2, 3]


def test_month_locks(spark):
    doctors = spark.createDataFrame([("DR1",), ("DR2",)], "doctor_id string")
    locks = schedule.month_locks(doctors)
    assert locks.count() == 2 * 296
    assert locks.agg(F.min(F.struct("year", "month")), F.max(F.struct("year", "month"))).first() == (
        (2026, 5),
        (2050, 12),
    )
    once = schedule.lock_months(locks, doctors.limit(1), 2026, 6)
    assert once.filter("is_inserted").count() == 1
    assert once.count() == 2 * 296


def test_month_arithmetic():
    assert schedule.month_bounds(2026, 12) == (D(2026, 12, 1), D(2027, 1, 1))
    assert schedule.previous_month(2026, 1) == (2025, 12)
    assert schedule.following_month(D(2026, 12, 31)) == (2027, 1)
    assert schedule.following_month(D(2026, 4, 30)) == (2026, 5)


def test_date_rules(spark):
    today = F.lit(D(2026, 11, 15))
    days = spark.createDataFrame(
        [(D(2026, 11, 15),), (D(2026, 11, 16),), (D(2026, 11, 17),), (D(2026, 12, 31),), (D(2027, 1, 1),), (None,)],
        "d date",
    )
    got = days.select(
        calendar.lead_time_ok(F.col("d"), today),
        calendar.slot_editable(F.col("d"), today),
        calendar.month_editable(F.col("d"), today),
    ).collect()
    assert [tuple(r) for r in got] == [
        (False, False, False),
        (False, True, False),
        (True, True, False),
        (True, True, False),
        (True, True, True),
        (False, False, False),
    ]
    months = days.limit(1).select(F.size(calendar.selectable_months(today))).first()[0]
    assert months == 24 * 12  # January 2027 to December 2050
    late = F.lit(D(2050, 12, 5))
    assert days.limit(1).select(F.size(calendar.selectable_months(late))).first()[0] == 0


def april(spark):
    mondays = [D(2026, 4, d) for d in (6, 13, 20, 27)]
    return spark.createDataFrame(
        [slot("DR1", m, "8A") for m in mondays[:2]]
        + [slot("DR1", mondays[0], "8B")]
        + [slot("DR1", mondays[1], "8B", "BOOKED")]
        + [slot("DR2", m, "9A") for m in mondays]
        + [slot("DR3", D(2026, 4, 5), "9A"), slot("DR3", D(2026, 4, 12), "9A")]
        + [slot("DR1", D(2026, 3, 30), "8B"), slot("DR1", D(2026, 5, 4), "8B", "BOOKED")],
        SLOTS,
    )


def test_preview(spark, rows):
    assert rows(schedule.preview(april(spark), 2026, 5)) == [
        ("DR1", 1, "8A", 2, "GREEN"),
        ("DR1", 1, "8B", 1, "RED"),
        ("DR2", 1, "9A", 4, "GREEN"),
    ]
    assert rows(schedule.preview(april(spark), 2026, 5, "DR2"), "doctor_id") == [("DR2",)]


def test_preview_grid(spark):
    doctors = spark.createDataFrame([("DR1",)], "doctor_id string")
    grid = schedule.preview_grid(doctors, schedule.preview(april(spark), 2026, 5))
    assert grid.count() == 96
    assert [tuple(r) for r in schedule.grid_choices(grid).collect()] == [("DR1", 1, "8A")]


def test_generate(spark):
    doctors = spark.createDataFrame([("DR1",), ("DR9",)], "doctor_id string")
    choices = spark.createDataFrame([("DR1", 5, "8A"), ("DR1", 1, "8A")], "doctor_id string, dow int, slot_code string")
    new = schedule.generate(doctors, choices, schedule.calendar_days(spark), 2026, 5)
    assert new.count() == 2 * 26 * 16
    mine = {r.slot_id: (r.slot_status, r.admin_status) for r in new.filter("doctor_id = 'DR1'").collect()}
    assert mine["20260501DR18A"] == ("BLOCKED", "BLOCKED")
    assert mine["20260508DR18A"] == ("AVAILABLE", "AVAILABLE")
    assert mine["20260508DR18B"] == ("BLOCKED", "AVAILABLE")
    assert not any(k.startswith("20260503") for k in mine)
    assert new.filter("doctor_id = 'DR9' and slot_status = 'AVAILABLE'").count() == 0


def test_merge_keeps_bookings_and_is_idempotent(spark, rows):
    current = spark.createDataFrame(
        [slot("DR1", D(2026, 5, 4), "8A", "BOOKED"), slot("DR1", D(2026, 5, 4), "8B", "BLOCKED")], SLOTS
    )
    new = spark.createDataFrame(
        [
            slot("DR1", D(2026, 5, 4), "8A", "BLOCKED", "BLOCKED"),
            slot("DR1", D(2026, 5, 4), "8B"),
            slot("DR1", D(2026, 5, 4), "9A"),
        ],
        SLOTS,
    )
    merged = schedule.merge_slots(current, new)
    assert rows(merged, "slot_code", "slot_status", "admin_status") == [
        ("8A", "BOOKED", "BLOCKED"),
        ("8B", "AVAILABLE", "AVAILABLE"),
        ("9A", "AVAILABLE", "AVAILABLE"),
    ]
    assert rows(schedule.merge_slots(merged, new)) == rows(merged)


def test_auto_generate(spark, rows):
    doctors = spark.createDataFrame([("DR1",), ("DR2",), ("DR3",)], "doctor_id string")
    locks = schedule.lock_months(
        schedule.month_locks(doctors), doctors.filter("doctor_id = 'DR2'"), 2026, 5
    )
    plan = schedule.auto_generate(doctors, april(spark), locks, schedule.calendar_days(spark), D(2026, 4, 30))
    assert rows(plan.doctors) == [("DR1",)]  # DR2 is locked, DR3 works on Sundays only
    assert plan.generated.count() == 26 * 16
    assert plan.slots.count() == april(spark).count() + 26 * 16 - 1
    kept = plan.slots.filter("slot_id = '20260504DR18B'").first()
    assert kept.slot_status == "BOOKED"
    again = schedule.auto_generate(doctors, plan.slots, plan.locks, schedule.calendar_days(spark), D(2026, 4, 30))
    assert again.generated.count() == 0
    assert rows(again.slots) == rows(plan.slots)


def test_monthly_job_writes_the_month(spark, tmp_path):
    source, target = str(tmp_path / "v1"), str(tmp_path / "v2")
    doctors = spark.createDataFrame([("DR1",)], "doctor_id string")
    doctors.write.parquet(f"{source}/doctor")
    slots_by_month = april(spark).withColumn("slot_month", F.date_format("slot_date", "yyyy-MM"))
    slots_by_month.write.partitionBy("slot_month").parquet(f"{source}/doctor_slot")
    schedule.month_locks(doctors).write.parquet(f"{source}/doctor_insert_month")
    schedule.calendar_days(spark).write.parquet(f"{source}/calendar_day")
    folder = monthly.run(spark, source, target, D(2026, 4, 30))
    assert folder.endswith("slot_month=2026-05")
    month = spark.read.parquet(folder)
    assert month.count() == 26 * 16
    assert month.filter("slot_status = 'BOOKED'").count() == 1
    locks = spark.read.parquet(f"{target}/doctor_insert_month").filter("is_inserted").collect()
    assert [(r.year, r.month) for r in locks] == [(2026, 5)]
    with pytest.raises(ValueError):
        monthly.run(spark, source, source + "/", D(2026, 4, 30))


def test_holiday_cascade(spark, rows):
    day, other = D(2026, 5, 4), D(2026, 5, 5)
    table = spark.createDataFrame(
        [slot("DR1", day, "8A", "BOOKED"), slot("DR1", day, "8B", "BLOCKED"), slot("DR1", other, "8A", "BOOKED", "BLOCKED")],
        SLOTS,
    )
    log = spark.createDataFrame(
        [("T1", "20260504DR18A", "BOOKED"), ("T2", "20260504DR18A", "CONFIRMED"), ("T3", "20260505DR18A", "BOOKED")],
        "transaction_id string, slot_id string, action string",
    )
    booked = spark.createDataFrame([(1, "20260504DR18A"), (2, "20260505DR18A")], "appointment_id int, slot_id string")
    days = schedule.calendar_days(spark)
    changes = spark.createDataFrame([(day, "HOLIDAY"), (other, "NORMAL_DAY")], "date date, status string")
    out = schedule.holiday_cascade(changes, days, log, booked, table)
    assert rows(out["transactions"], "transaction_id", "action") == [
        ("T1", "CANCELLED"), ("T2", "CANCELLED"), ("T3", "BOOKED"),
    ]
    assert rows(out["appointments"], "appointment_id") == [(2,)]
    assert rows(out["slots"], "slot_id", "slot_status", "admin_status") == [
        ("20260504DR18A", "AVAILABLE", "BLOCKED"),
        ("20260504DR18B", "BLOCKED", "BLOCKED"),
        ("20260505DR18A", "BOOKED", "AVAILABLE"),
    ]
    assert out["calendar"].filter(F.col("date") == day).first().status == "HOLIDAY"
    assert out["calendar"].count() == days.count()


def test_availability(spark):
    day = D(2026, 5, 4)
    table = spark.createDataFrame(
        [
            slot("DR1", day, "8A", "BOOKED"),
            slot("DR1", day, "8B", "AVAILABLE", "BLOCKED"),
            slot("DR1", day, "9A"),
            slot("DR1", day, "9B", "CANCELLED"),
            slot("DR1", day, "10A", "AVAILABLE"),
        ],
        SLOTS,
    )
    booked = spark.createDataFrame(
        [("20260504DR18A", 5), ("20260504DR110A", 0)], "slot_id string, patient_id int"
    )
    wanted = spark.createDataFrame([("DR1", day), ("DR1", day), ("DR2", day)], "doctor_id string, slot_date date")
    out = slots.availability(wanted, table, booked)
    assert out.count() == 32
    shown = {r.slot_code: r.slot_status for r in out.filter("doctor_id = 'DR1'").collect()}
    assert [shown[c] for c in ("8A", "8B", "9A", "9B", "10A", "10B")] == [
        "BOOKED", "BLOCKED", "AVAILABLE", "NOT_AVAILABLE", "AVAILABLE", "NOT_AVAILABLE",
    ]
    empty = out.filter("doctor_id = 'DR2'").first()
    assert (empty.slot_id, empty.admin_status, empty.patient_id) == (None, "AVAILABLE", None)
    assert slots.slot_id_at(table, "DR1", day, "9A").first().slot_id == "20260504DR19A"


def test_patient_in_slot(spark, rows):
    day = D(2026, 5, 4)
    table = spark.createDataFrame(
        [slot("DR1", day, "8A", "BOOKED"), slot("DR1", day, "8B", "BOOKED", "BLOCKED")], SLOTS
    )
    booked = spark.createDataFrame([("20260504DR18A", 5), ("20260504DR18B", 6)], "slot_id string, patient_id int")
    assert rows(slots.patient_in_slot(table, booked), "patient_id") == [(5,)]
    assert slots.patient_in_slot(table, booked, ("DR1", day, "8B")).count() == 0
    assert slots.patient_in_slot(table, booked, ("DR1", day, "8A")).count() == 1


def test_doctor_and_patient_views(spark):
    states = spark.createDataFrame(
        [(None, None, D(2026, 6, 1)), ("BOOKED", "BLOCKED", D(2026, 6, 1)), ("BOOKED", "AVAILABLE", D(2020, 1, 1)),
         ("BLOCKED", "AVAILABLE", D(2020, 1, 1)), ("AVAILABLE", "AVAILABLE", D(2020, 1, 1)),
         ("AVAILABLE", "AVAILABLE", D(2026, 6, 1))],
        "s string, a string, d date",
    )
    seen = states.select(status.doctor_view(F.col("s"), F.col("a"), F.col("d"), F.lit(D(2026, 1, 1)))).collect()
    assert [r[0] for r in seen] == [
        "NOT AVAILABLE", "BLOCKED BY ADMIN", "BOOKED", "LOCKED: DOCTOR BLOCKED", "LOCKED: AVAILABLE", "AVAILABLE",
    ]
    patient = states.select(status.patient_view(F.col("s")), status.owned_by(F.col("s"), F.lit(3), F.lit(3))).collect()
    assert [tuple(r) for r in patient][:2] == [("NOT_AVAILABLE", 0), ("BOOKED", 1)]


def one_by_one(table, updates, holidays, booked):
    state = {r[0]: list(r) for r in table}
    place = {tuple(r[1:4]): r[0] for r in table}
    messages = {}
    for uid, doctor, day, code, value, _ in sorted(updates, key=lambda u: (u[5], u[0])):
        sid = place.get((doctor, day, code))
        if day in holidays:
            messages[uid] = slots.HOLIDAY
        elif sid and sid in booked and value != "BOOKED":
            messages[uid] = slots.BOOKED
        elif sid:
            state[sid][4] = value
            messages[uid] = slots.UPDATED
        else:
            sid = f"{day:%Y%m%d}{doctor}{code}"
            place[(doctor, day, code)] = sid
            state[sid] = [sid, doctor, day, code, value, "AVAILABLE"]
            messages[uid] = slots.CREATED
    return messages, sorted(tuple(v) for v in state.values())


def test_slot_updates_equal_one_at_a_time(spark, rows):
    import random

    rng = random.Random(4)
    days = [D(2026, 4, 30), D(2026, 5, 4), D(2026, 5, 5)]
    codes = ["8A", "8B", "9A"]
    table = [slot("DR1", d, c, rng.choice(["AVAILABLE", "BOOKED"])) for d in days for c in codes[:2]]
    booked = {r[0] for r in table if rng.random() < 0.4}
    updates = [
        (i, "DR1", rng.choice(days), rng.choice(codes), rng.choice(["AVAILABLE", "BLOCKED", "BOOKED"]),
         dt.datetime(2026, 1, 1, 0, 0, rng.randrange(20)))
        for i in range(60)
    ]
    messages, final = one_by_one(table, updates, {D(2026, 4, 30)}, booked)
    out, verdicts = slots.apply_updates(
        spark.createDataFrame(table, SLOTS),
        spark.createDataFrame(
            updates,
            "update_id int, doctor_id string, slot_date date, slot_code string, status string, requested_at timestamp",
        ),
        schedule.calendar_days(spark),
        spark.createDataFrame([(s,) for s in booked], "slot_id string"),
    )
    assert {r.update_id: r.message for r in verdicts.collect()} == messages
    assert rows(out) == final


def test_template(spark):
    template = schedule.slot_template(spark)
    assert template.count() == 16
    orders = template.select("display_order", schedule.display_order(F.col("slot_code")).alias("o")).collect()
    assert all(r.display_order == r.o for r in orders)
    keys = spark.range(1).select(*text.split_pattern_key(text.pattern_key(F.lit(3), F.lit("10A")))).first()
    assert tuple(keys) == (3, "10A")
