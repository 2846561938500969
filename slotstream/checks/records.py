"""Queries on medical records, appointment lists and other reads."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.checks.base import query, with_place
from slotstream.operators import reads, records, substring
from slotstream.session import materialise, run_dir
from slotstream.testdata import view, with_views


@query(
    "latest_record_per_slot",
    with_views("v_record")
    + "SELECT DISTINCT ON (slot_id) * FROM v_record ORDER BY slot_id, version_number DESC, record_id DESC",
)
def latest_record_per_slot(spark: SparkSession, sf: str) -> DataFrame:
    return records.latest_per_slot(view(spark, sf, "v_record"))


@query(
    "record_latest_detail",
    with_views("v_record", "v_slot", "v_appointment", "v_patient")
    + """, newest AS (SELECT DISTINCT ON (slot_id) * FROM v_record ORDER BY slot_id, version_number DESC, record_id DESC)
SELECT s.slot_id, s.slot_date, a.patient_id, p.patient_name, r.record_id, r.version_number, r.diagnosis_note,
  r.prescription_note, r.created_at
FROM v_slot s JOIN v_appointment a ON s.slot_id = a.slot_id JOIN v_patient p ON a.patient_id = p.patient_id
LEFT JOIN newest r ON r.slot_id = s.slot_id""",
)
def record_latest_detail(spark: SparkSession, sf: str) -> DataFrame:
    return records.latest_detail(
        *[view(spark, sf, v) for v in ("v_slot", "v_appointment", "v_patient", "v_record")]
    )


@query(
    "records_by_doctor",
    with_views("v_record", "v_slot", "v_patient")
    + """SELECT DISTINCT ON (r.slot_id) s.doctor_id, r.record_id, r.slot_id, r.patient_id, p.patient_name,
  r.version_number, r.diagnosis_note, r.prescription_note, s.slot_date, s.slot_code, r.created_at
FROM v_record r JOIN v_slot s ON r.slot_id = s.slot_id JOIN v_patient p ON r.patient_id = p.patient_id
ORDER BY r.slot_id, r.version_number DESC, r.record_id DESC""",
)
def records_by_doctor(spark: SparkSession, sf: str) -> DataFrame:
    return records.by_doctor(*[view(spark, sf, v) for v in ("v_record", "v_slot", "v_patient")])


@query(
    "records_by_slot",
    with_views("v_record", "v_slot", "v_patient")
    + """SELECT r.*, p.patient_name, s.slot_date, s.slot_code,
  row_number() OVER (ORDER BY r.slot_id, r.version_number DESC, r.record_id) AS place
FROM v_record r JOIN v_slot s ON r.slot_id = s.slot_id JOIN v_patient p ON r.patient_id = p.patient_id""",
)
def records_by_slot(spark: SparkSession, sf: str) -> DataFrame:
    return with_place(
        records.by_slot(*[view(spark, sf, v) for v in ("v_record", "v_slot", "v_patient")])
    )


@query(
    "records_by_insurance",
    with_views("v_record", "v_slot", "v_patient", "v_doctor")
    + """SELECT *, row_number() OVER (ORDER BY doctor_id, slot_id, insurance_number) AS place FROM (
SELECT DISTINCT ON (r.patient_id, r.slot_id) p.insurance_number, s.doctor_id, d.doctor_name,
  r.record_id AS medical_record_id, r.slot_id, s.slot_date AS date, s.slot_code, r.version_number
FROM v_record r JOIN v_slot s ON r.slot_id = s.slot_id JOIN v_patient p ON r.patient_id = p.patient_id
JOIN v_doctor d ON s.doctor_id = d.doctor_id
ORDER BY r.patient_id, r.slot_id, r.version_number DESC, r.record_id DESC)""",
)
def records_by_insurance(spark: SparkSession, sf: str) -> DataFrame:
    return with_place(
        records.by_insurance(
            *[view(spark, sf, v) for v in ("v_record", "v_slot", "v_patient", "v_doctor")]
        )
    )


@query(
    "next_version",
    with_views("v_record")
    + """SELECT slot_id, patient_id, CAST(max(version_number) + 1 AS INT) AS next_version
FROM v_record GROUP BY slot_id, patient_id""",
)
def next_version(spark: SparkSession, sf: str) -> DataFrame:
    return records.next_version(view(spark, sf, "v_record"))


@query(
    "append_versions",
    with_views("v_record", "v_txn")
    + """, fresh AS (SELECT t.transaction_id, t.slot_id, coalesce(r.patient_id, t.patient_id) AS patient_id, t.created_at
  FROM v_txn t LEFT JOIN (SELECT DISTINCT slot_id, patient_id FROM v_record) r ON r.slot_id = t.slot_id)
SELECT f.*, CAST(coalesce(m.v, 0) + row_number() OVER (PARTITION BY f.slot_id, f.patient_id
  ORDER BY created_at, transaction_id) AS INT) AS version_number
FROM fresh f LEFT JOIN (SELECT slot_id, patient_id, max(version_number) AS v FROM v_record GROUP BY ALL) m
  ON m.slot_id = f.slot_id AND m.patient_id = f.patient_id""",
)
def append_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Every log entry leaves a new record version; some go on from records that exist."""
    current = view(spark, sf, "v_record")
    owners = current.select("slot_id", F.col("patient_id").alias("_owner")).distinct()
    new = (
        view(spark, sf, "v_txn")
        .join(owners, "slot_id", "left")
        .select("transaction_id", "slot_id", F.coalesce("_owner", "patient_id").alias("patient_id"), "created_at")
    )
    return records.append_versions(current, new, ["created_at", "transaction_id"])


_PATIENT_APPOINTMENTS = (
    with_views("v_appointment", "v_slot")
    + """SELECT a.patient_id, s.doctor_id, s.slot_date, s.slot_code, a.booking_ref, a.booked_at
FROM v_appointment a JOIN v_slot s ON a.slot_id = s.slot_id"""
)


def patient_appointments(spark: SparkSession, sf: str) -> DataFrame:
    return reads.patient_appointments(view(spark, sf, "v_appointment"), view(spark, sf, "v_slot"))


@query(
    "patient_appointments",
    _PATIENT_APPOINTMENTS.replace(
        "a.booked_at\n",
        """a.booked_at,
  row_number() OVER (ORDER BY a.patient_id, s.slot_date, s.slot_code, a.booking_ref) AS place\n""",
    ),
)
def patient_appointments_in_order(spark: SparkSession, sf: str) -> DataFrame:
    return with_place(patient_appointments(spark, sf))


@query(
    "doctor_appointments",
    with_views("v_appointment", "v_slot")
    + """SELECT s.doctor_id, a.patient_id, s.slot_id, s.slot_date, s.slot_code,
  row_number() OVER (ORDER BY s.doctor_id, s.slot_date, s.slot_code, s.slot_id) AS place
FROM v_appointment a JOIN v_slot s ON a.slot_id = s.slot_id""",
)
def doctor_appointments(spark: SparkSession, sf: str) -> DataFrame:
    return with_place(
        reads.doctor_appointments(view(spark, sf, "v_appointment"), view(spark, sf, "v_slot"))
    )


@query(
    "history_day",
    _PATIENT_APPOINTMENTS + " WHERE s.slot_date = DATE '1998-08-17'",
)
def history_day(spark: SparkSession, sf: str) -> DataFrame:
    return reads.history(patient_appointments(spark, sf), dt.date(1998, 8, 17))


@query(
    "history_page",
    _PATIENT_APPOINTMENTS + " ORDER BY slot_date, slot_code, booking_ref LIMIT 5 OFFSET 10",
)
def history_page(spark: SparkSession, sf: str) -> DataFrame:
    return reads.page(
        reads.history(patient_appointments(spark, sf)), ["slot_date", "slot_code", "booking_ref"], 3
    )


@query(
    "history_after",
    _PATIENT_APPOINTMENTS
    + """ WHERE (s.slot_date, s.slot_code, a.booking_ref) > (DATE '1995-01-01', '8A', '')
ORDER BY s.slot_date, s.slot_code, a.booking_ref LIMIT 5""",
)
def history_after(spark: SparkSession, sf: str) -> DataFrame:
    """The page after a given row, which costs the same wherever it is."""
    return reads.page_after(
        reads.history(patient_appointments(spark, sf)),
        ["slot_date", "slot_code", "booking_ref"],
        (dt.date(1995, 1, 1), "8A", ""),
    )


@query(
    "history_page_count",
    with_views("v_appointment", "v_slot")
    + """SELECT CAST(ceil(count(*) / 5.0) AS BIGINT) AS pages
FROM v_appointment a JOIN v_slot s ON a.slot_id = s.slot_id""",
)
def history_page_count(spark: SparkSession, sf: str) -> DataFrame:
    return reads.page_count(patient_appointments(spark, sf))


SEARCH_SQL = (
    with_views("v_record", "v_slot", "v_doctor")
    + """SELECT r.record_id, d.doctor_id, d.doctor_name FROM v_record r JOIN v_slot s ON r.slot_id = s.slot_id
JOIN v_doctor d ON d.doctor_id = s.doctor_id
WHERE contains(lower(d.doctor_name), 'r#00000000') OR contains(lower(d.doctor_id), 'r#00000000')"""
)


def searched(spark: SparkSession, sf: str) -> DataFrame:
    return (
        view(spark, sf, "v_record")
        .join(view(spark, sf, "v_slot").select("slot_id", "doctor_id"), "slot_id")
        .join(view(spark, sf, "v_doctor").select("doctor_id", "doctor_name"), "doctor_id")
        .select("record_id", "doctor_id", "doctor_name")
    )


@query("search_records", SEARCH_SQL)
def search_records(spark: SparkSession, sf: str) -> DataFrame:
    return reads.search(searched(spark, sf), "R#00000000", ["doctor_name", "doctor_id"])


@query("search_records_indexed", SEARCH_SQL)
def search_records_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The same search through a stored index of the records."""
    columns = ["doctor_name", "doctor_id"]
    rows = materialise(searched(spark, sf))
    path = run_dir(spark, "grams")
    substring.write(substring.postings(rows, "record_id", columns), path)
    return substring.search(rows, spark.read.parquet(path), "record_id", "R#00000000", columns)


@query(
    "search_notes_indexed",
    with_views("v_record")
    + """, keywords AS (SELECT * FROM (VALUES ('note'), ('"'), ('42'), ('A')) k(keyword))
SELECT keyword, record_id FROM v_record, keywords WHERE contains(lower(coalesce(diagnosis_note, '')), lower(keyword))
  OR contains(lower(coalesce(prescription_note, '')), lower(keyword))""",
)
def search_notes_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Several keywords, one or two characters short as well, in the notes of all records."""
    columns = ["diagnosis_note", "prescription_note"]
    rows = view(spark, sf, "v_record").select("record_id", *columns)
    path = run_dir(spark, "grams")
    substring.write(substring.postings(rows, "record_id", columns), path)
    index = spark.read.parquet(path)
    found = [
        substring.search(rows, index, "record_id", keyword, columns).select(
            F.lit(keyword).alias("keyword"), "record_id"
        )
        for keyword in ("note", '"', "42", "A")
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "lookup_by_key",
    with_views("v_patient")
    + "SELECT patient_id, patient_name, insurance_number FROM v_patient WHERE patient_id = 42",
)
def lookup_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return reads.by_key(view(spark, sf, "v_patient"), "patient_id", 42).select(
        "patient_id", "patient_name", "insurance_number"
    )


@query("specialties", with_views("v_doctor") + "SELECT DISTINCT specialty FROM v_doctor")
def specialties(spark: SparkSession, sf: str) -> DataFrame:
    return reads.specialties(view(spark, sf, "v_doctor"))


@query(
    "doctors_by_specialty",
    with_views("v_doctor")
    + "SELECT doctor_id, doctor_name, specialty FROM v_doctor WHERE specialty = 'NATION_3'",
)
def doctors_by_specialty(spark: SparkSession, sf: str) -> DataFrame:
    return reads.doctors_by_specialty(view(spark, sf, "v_doctor"), "NATION_3")


@query(
    "insurance_numbers",
    with_views("v_patient")
    + "SELECT insurance_number, row_number() OVER (ORDER BY insurance_number) AS place FROM v_patient",
)
def insurance_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return with_place(reads.insurance_numbers(view(spark, sf, "v_patient")))


@query(
    "ordered_records",
    with_views("v_record")
    + "SELECT *, row_number() OVER (ORDER BY slot_id, patient_id, version_number) AS place FROM v_record",
)
def ordered_records(spark: SparkSession, sf: str) -> DataFrame:
    return with_place(
        reads.ordered(view(spark, sf, "v_record"), ["slot_id", "patient_id", "version_number"])
    )
