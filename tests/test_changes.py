"""Changes touch only the parts their keys lie in, and give what whole tables would."""

import datetime as dt

import pytest

from slotstream.operators import schedule
from slotstream.plans import changes
from slotstream.sinks import keyed

SLOT = "slot_id string, doctor_id string, slot_date date, slot_code string, slot_status string, admin_status string"


def day(n):
    return dt.date(2026, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def tables(spark, tmp_path):
    """100 days of ten slots; every third slot is booked."""
    slots = [
        (f"{day(n):%Y%m%d}D{k}", f"D{k}", day(n), "A", "BOOKED" if k % 3 == 0 else "AVAILABLE", "AVAILABLE")
        for n in range(100)
        for k in range(10)
    ]
    booked = [(i, s[0]) for i, s in enumerate(slots) if s[4] == "BOOKED"]
    made = {
        "calendar": spark.createDataFrame([(day(n), "NORMAL_DAY") for n in range(100)], "date date, status string"),
        "slots": spark.createDataFrame(slots, SLOT),
        "appointments": spark.createDataFrame(booked, "appointment_id int, slot_id string"),
        "transactions": spark.createDataFrame(
            [(f"T{i}", s, "BOOKED") for i, s in booked], "transaction_id string, slot_id string, action string"
        ),
    }
    keys = {"calendar": "date", "slots": "slot_date", "appointments": "slot_id", "transactions": "slot_id"}
    return made, {
        n: changes.Kept.create(df, f"{tmp_path}/{n}", [keys[n]], parts=16) for n, df in made.items()
    }


def same(a, b):
    return sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


def test_a_holiday_touches_its_day(spark, tmp_path, tables):
    made, kept = tables
    before = {n: keyed.manifest(spark, t.folder, 0)[0] for n, t in kept.items()}
    new = spark.createDataFrame([(day(7), "HOLIDAY")], "date date, status string")
    order = [kept[n] for n in ("calendar", "slots", "appointments", "transactions")]
    touched = changes.change_days(new, *order)
    wanted = schedule.holiday_cascade(
        new, made["calendar"], made["transactions"], made["appointments"], made["slots"]
    )
    for n, t in kept.items():
        assert same(t.read(), wanted[n])
        after = keyed.manifest(spark, t.folder, 1)[0]
        assert {p for p in after if after[p] != before[n][p]} == set(touched[n])
    assert len(touched["calendar"]) == len(touched["slots"]) == 1
    assert len(touched["appointments"]) <= 10 < 16
    # again, and undone
    changes.change_days(new, *order)
    assert all(same(t.read(), wanted[n]) for n, t in kept.items())
    back = spark.createDataFrame([(day(7), "NORMAL_DAY")], "date date, status string")
    changes.change_days(back, *order)
    assert same(kept["calendar"].read(), made["calendar"])
    assert kept["appointments"].read().count() == made["appointments"].count() - 4


def test_merge_upsert_and_delete(spark, tables):
    made, kept = tables
    new = spark.createDataFrame(
        [(f"{day(n):%Y%m%d}D{k}", f"D{k}", day(n), "A", "BLOCKED", "BLOCKED") for n in (3, 120) for k in (3, 4)], SLOT
    )
    assert 1 <= len(changes.merge_slots(kept["slots"], new)) <= 2
    assert same(kept["slots"].read(), schedule.merge_slots(made["slots"], new))
    days = spark.createDataFrame([(day(5), "HOLIDAY"), (day(500), "WEEKEND")], "date date, status string")
    assert len(kept["calendar"].upsert(days, ["date"])) <= 2
    assert kept["calendar"].read().count() == 101
    gone = made["appointments"].filter("appointment_id < 20").select("slot_id")
    kept["appointments"].delete(gone)
    assert same(kept["appointments"].read(), made["appointments"].filter("appointment_id >= 20"))
    assert kept["appointments"].delete(gone.limit(0)) == []
    assert same(kept["appointments"].read(), made["appointments"].filter("appointment_id >= 20"))


def test_rows_must_stay_in_their_parts(spark, tables):
    _, kept = tables
    one = spark.createDataFrame([(day(1),)], "date date")
    with pytest.raises(ValueError, match="no key named"):
        kept["calendar"].apply(one, lambda rows: kept["calendar"].read())
    assert kept["calendar"].read().count() == 100
