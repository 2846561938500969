"""Mutations, records, reads and quality audits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slotstream.functions import text
from slotstream.operators import mutations, quality, reads, records

KV = "k int, a string, b string"


def test_insert_ignore(spark, rows):
    current = spark.createDataFrame([(1, "a", "b")], KV)
    new = spark.createDataFrame([(1, "x", "x"), (2, "second", "9"), (2, "first", "1")], KV)
    assert rows(mutations.insert_ignore(current, new, ["k"], ["b"])) == [(1, "a", "b"), (2, "first", "1")]


def test_upsert_overwrites_with_null_and_keeps_missing_columns(spark, rows):
    current = spark.createDataFrame([(1, "a", "b"), (3, "c", "d")], KV)
    new = spark.createDataFrame([(1, None), (2, "n")], "k int, a string")
    assert rows(mutations.upsert(current, new, ["k"])) == [(1, None, "b"), (2, "n", None), (3, "c", "d")]


def test_update_rows(spark, rows):
    current = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], KV).withColumn(
        "updated_at", F.lit(dt.datetime(2020, 1, 1))
    )
    changes = spark.createDataFrame([(1, "new"), (9, "none")], "k int, a string")
    out = mutations.update_rows(current, changes, ["k"], ["a", "b"], now=F.lit(dt.datetime(2026, 1, 1)))
    assert rows(out) == [
        (1, "new", None, dt.datetime(2026, 1, 1)),
        (2, "c", "d", dt.datetime(2020, 1, 1)),
    ]


def test_delete_keys(spark, rows):
    current = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], KV)
    gone = spark.createDataFrame([(1,), (1,), (7,)], "k int")
    assert rows(mutations.delete_keys(current, gone, ["k"])) == [(2, "c", "d")]


def test_defaults_keep_types(spark):
    df = spark.createDataFrame([(None, None), (None, "PAID")], "amount_covered decimal(12,2), payment_status string")
    out = mutations.with_defaults(df, {"amount_covered": 0, "payment_status": "PENDING"})
    assert out.schema["amount_covered"].dataType.simpleString() == "decimal(12,2)"
    assert sorted(r.payment_status for r in out.collect()) == ["PAID", "PENDING"]


RECORDS = "record_id string, slot_id string, patient_id int, version_number int, diagnosis_note string, prescription_note string, created_at timestamp"


def clinic(spark):
    slots = spark.createDataFrame(
        [("S1", "DR1", dt.date(2026, 5, 4), "8A"), ("S2", "DR2", dt.date(2026, 5, 4), "8B"), ("S3", "DR1", dt.date(2026, 5, 5), "8A")],
        "slot_id string, doctor_id string, slot_date date, slot_code string",
    )
    booked = spark.createDataFrame([("S1", 1), ("S2", 2), ("S3", 1)], "slot_id string, patient_id int")
    patients = spark.createDataFrame(
        [(1, "Ann", "GD1"), (2, "Bo", "GD2"), (3, "Cy", None)], "patient_id int, patient_name string, insurance_number string"
    )
    doctors = spark.createDataFrame([("DR1", "D One"), ("DR2", "D Two")], "doctor_id string, doctor_name string")
    notes = spark.createDataFrame(
        [("R1", "S1", 1, 1, "n1", None, None), ("R2", "S1", 1, 2, "n2", None, None), ("R3", "S2", 2, 1, "n3", None, None),
         ("R4", "S2", 99, 7, "no such patient", None, None)],
        RECORDS,
    )
    return slots, booked, patients, doctors, notes


def test_records(spark, rows):
    slots, booked, patients, doctors, notes = clinic(spark)
    detail = records.latest_detail(slots, booked, patients, notes)
    assert rows(detail, "slot_id", "patient_name", "record_id") == [
        ("S1", "Ann", "R2"), ("S2", "Bo", "R4"), ("S3", "Ann", None),
    ]
    assert rows(records.latest_detail(slots, booked, patients, notes, "S1"), "version_number") == [(2,)]
    assert rows(records.by_doctor(notes, slots, patients), "doctor_id", "record_id") == [("DR1", "R2"), ("DR2", "R3")]
    assert rows(records.by_doctor(notes, slots, patients, "DR2"), "record_id") == [("R3",)]
    assert [r.record_id for r in records.by_slot(notes, slots, patients, "S1").collect()] == ["R2", "R1"]
    assert rows(records.by_insurance(notes, slots, patients, doctors, "GD1"), "medical_record_id") == [("R2",)]
    assert records.by_insurance(notes, slots, patients, doctors, "nobody").count() == 0
    assert [r.doctor_id for r in records.by_insurance(notes, slots, patients, doctors).collect()] == ["DR1", "DR2"]


def test_reads(spark, rows):
    slots, booked, patients, doctors, _ = clinic(spark)
    booked = booked.withColumns({"booking_ref": F.col("slot_id"), "booked_at": F.lit(None).cast("timestamp")})
    assert [r.slot_code for r in reads.patient_appointments(booked, slots, 1).collect()] == ["8A", "8A"]
    assert rows(reads.doctor_appointments(booked, slots, "DR2"), "slot_id") == [("S2",)]
    assert rows(reads.search(doctors, "ONE", ["doctor_name", "doctor_id"]), "doctor_id") == [("DR1",)]
    assert reads.search(doctors, "", ["doctor_name"]).count() == 2
    numbered = spark.range(12)
    assert [r.id for r in reads.page(numbered, ["id"], 3).collect()] == [10, 11]
    assert reads.page_count(numbered).first().pages == 3
    with pytest.raises(ValueError):
        reads.page(numbered, ["id"], 0)
    assert rows(reads.insurance_numbers(patients)) == [("GD1",), ("GD2",)]


def test_quality(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, None), (None, None)], "k int, v string")
    assert rows(quality.duplicates(df, ["k"])) == [(1, 2)]
    assert rows(quality.not_null(df, ["k", "v"])) == [("k", 2), ("v", 3)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.orphans(df, "k", parent, "id")) == [(2, None)]
    assert rows(quality.domain(df, "v", ["b"])) == [(1, "a"), (1, "a")]
    assert rows(quality.check(df, F.col("k") > 1)) == [(1, "a"), (1, "a")]


def test_registration(spark):
    good = ("0123456789", "a@b.c", "GD", "1" * 13, "male", dt.date(2000, 1, 1))
    faults = [
        good,
        ("123", "bad", "GD", "1", "x", dt.date(2020, 1, 1)),
        ("0123456789", "bad", "GD", "1", "x", dt.date(2020, 1, 1)),
        ("0123456789", "a@b.c", "GD", "1", "x", dt.date(2020, 1, 1)),
        ("0123456789", "a@b.c", "GD", "2" * 13, "x", dt.date(2020, 1, 1)),
        ("0123456789", "a@b.c", "GD", "1" * 13, "x", dt.date(2020, 1, 1)),
        ("0123456789", "a@b.c", "GD", "1" * 13, "male", dt.date(2017, 1, 1)),
        ("0123456789", "a@b.c", "GD", "1" * 13, "male", dt.date(2016, 1, 1)),
        (None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(faults)],
        "i int, phone string, email string, insurance_prefix string, insurance_digits string, gender string, date_of_birth date",
    )
    known = spark.createDataFrame([("GD" + "2" * 13,), ("GD" + "2" * 13,)], "insurance_number string")
    out = quality.registration_checks(df, known, F.lit(dt.date(2026, 6, 1)))
    assert [r.reject_reason for r in out.orderBy("i").collect()] == [
        None,
        "Phone must be 10 digits and start with 0",
        "Invalid email",
        "Insurance number must be 13 digits",
        "Insurance already exists",
        "Gender must be male or female",
        "DOB must be before 2016",
        None,
        "Phone must be 10 digits and start with 0",
    ]


def test_expected_tables(spark):
    spark.range(1).createOrReplaceTempView("here")
    quality.expect_tables(spark, ["here"])
    with pytest.raises(LookupError, match="not_here"):
        quality.expect_tables(spark, ["here", "not_here"])


def test_text(spark):
    one = spark.range(1).select(
        text.zero_fill(F.lit("12345678901"), 10),
        text.zero_fill(F.lit("912345678"), 10),
        text.valid_insurance(F.lit("GD0000000000001")),
        text.valid_insurance(F.lit("XX0000000000001")),
        text.nan_to_null(F.lit(float("nan"))),
        text.parse_event_time(F.lit("2026-05-01T08:30:00.250Z")).cast("string"),
        text.parse_event_time(F.lit("2026-05-01 08:30:00")).cast("string"),
        text.parse_event_time(F.lit("2026-05-01")).cast("string"),
        text.parse_event_time(F.lit("soon")),
        text.parse_event_time(F.lit(None)),
    ).first()
    assert tuple(one) == (
        "12345678901",
        "0912345678",
        True,
        False,
        None,
        "2026-05-01 08:30:00.25",
        "2026-05-01 08:30:00",
        "2026-05-01 00:00:00",
        None,
        None,
    )
