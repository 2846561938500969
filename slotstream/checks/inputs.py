"""Queries on inputs: tables written as CSV and loaded again, the first load, raw topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.checks.base import query
from slotstream.checks.change_data import slot_messages
from slotstream.functions import text
from slotstream.plans import seed
from slotstream.session import run_dir
from slotstream.sources import files, topics
from slotstream.sources.registry import TABLES
from slotstream.testdata import messages, view, with_views


def as_csv(df: DataFrame) -> str:
    """The path of a folder of CSV files with headers."""
    path = run_dir(df.sparkSession, "csv")
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def twelve_hour(column: str) -> Column:
    return F.lower(F.date_format(column, text.TWELVE_HOUR))


def doctor_file(spark: SparkSession, sf: str) -> str:
    return as_csv(
        view(spark, sf, "v_doctor").select(
            F.col("doctor_name").alias("doctorName"),
            "specialty",
            F.date_format("start_working_date", text.US_DATE).alias("StartWorkingDate"),
        )
    )


@query(
    "csv_doctor",
    with_views("v_doctor") + "SELECT doctor_name, specialty, start_working_date FROM v_doctor",
)
def csv_doctor(spark: SparkSession, sf: str) -> DataFrame:
    return files.doctor_csv(spark, doctor_file(spark, sf))


def patient_file(spark: SparkSession, sf: str) -> str:
    """Patients; the phone number is written as a number and loses its leading zero."""
    return as_csv(
        view(spark, sf, "v_patient").select(
            F.col("patient_name").alias("patientName"),
            "address",
            F.col("phone_number").cast("long").alias("phoneNumber"),
            F.col("insurance_number").alias("insuranceNumber"),
            F.col("date_of_birth").alias("dateOfBirth"),
            "gender",
            "email",
        )
    )


@query(
    "csv_patient",
    with_views("v_patient")
    + "SELECT patient_name, address, phone_number, insurance_number, date_of_birth, gender, email FROM v_patient",
)
def csv_patient(spark: SparkSession, sf: str) -> DataFrame:
    return files.patient_csv(spark, patient_file(spark, sf))


def slot_file(spark: SparkSession, sf: str) -> str:
    return as_csv(
        view(spark, sf, "v_slot").select(
            F.col("slot_id").alias("slotID"),
            F.col("doctor_id").alias("doctorID"),
            F.col("slot_date").alias("date"),
            F.col("slot_code").alias("slotCode"),
        )
    )


@query(
    "csv_slot",
    with_views("v_slot")
    + """SELECT slot_id, doctor_id, slot_date, slot_code, 'AVAILABLE' AS slot_status, 'AVAILABLE' AS admin_status
FROM v_slot""",
)
def csv_slot(spark: SparkSession, sf: str) -> DataFrame:
    return files.slot_csv(spark, slot_file(spark, sf))


def transaction_file(spark: SparkSession, sf: str) -> str:
    """The booking log in order of time, file after file."""
    return as_csv(
        view(spark, sf, "v_txn").orderBy("created_at", "transaction_id").select(
            F.col("slot_id").alias("slotID"),
            F.col("patient_id").alias("patientID"),
            F.lower("action").alias("status"),
            twelve_hour("created_at").alias("event_timestamp"),
        )
    )


@query(
    "csv_transaction",
    with_views("v_txn")
    + "SELECT slot_id, patient_id, action, date_trunc('minute', created_at) AS created_at FROM v_txn",
)
def csv_transaction(spark: SparkSession, sf: str) -> DataFrame:
    return files.transaction_csv(spark, transaction_file(spark, sf))


@query(
    "csv_appointment",
    with_views("v_appointment") + "SELECT booking_ref, slot_id, patient_id, booked_at FROM v_appointment",
)
def csv_appointment(spark: SparkSession, sf: str) -> DataFrame:
    path = as_csv(
        view(spark, sf, "v_appointment").select(
            "booking_ref",
            F.col("slot_id").alias("slotID"),
            F.col("patient_id").alias("patientID"),
            twelve_hour("booked_at").alias("booked_at"),
        )
    )
    return files.appointment_csv(spark, path)


def record_rows(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "v_record").select(
        F.col("slot_id").alias("slotID"),
        F.col("patient_id").alias("patientID"),
        F.col("version_number").alias("version"),
        F.col("diagnosis_note").alias("diagnosis"),
        F.col("prescription_note").alias("treatment"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm").alias("updated_at"),
    )


def record_file(spark: SparkSession, sf: str) -> str:
    return as_csv(record_rows(spark, sf))


RECORD_SQL = (
    with_views("v_record")
    + """SELECT slot_id, patient_id, version_number, diagnosis_note, prescription_note, created_at,
  created_at AS updated_at FROM v_record"""
)


@query("csv_record", RECORD_SQL)
def csv_record(spark: SparkSession, sf: str) -> DataFrame:
    """Notes run over several lines and hold quotes and commas."""
    return files.record_csv(spark, record_file(spark, sf))


@query("csv_record_splits", RECORD_SQL)
def csv_record_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The same file, read by several tasks when it is large."""
    return files.record_csv(spark, record_file(spark, sf), splits=True)


@query(
    "seed_appointments",
    with_views("v_txn")
    + """, numbered AS (SELECT slot_id, patient_id, action, date_trunc('minute', created_at) AS created_at, 'TXN26' || lpad(
  CAST(row_number() OVER (ORDER BY v_txn.created_at, transaction_id) AS STRING), 8, '0') AS booking_ref FROM v_txn),
live AS (SELECT booking_ref, slot_id, patient_id, created_at AS booked_at FROM (SELECT *, row_number() OVER (
  PARTITION BY slot_id ORDER BY created_at DESC, booking_ref DESC) AS rn FROM numbered) WHERE rn = 1 AND action = 'BOOKED')
SELECT *, CAST(row_number() OVER (ORDER BY booked_at, booking_ref) AS INT) AS appointment_id FROM live""",
)
def seed_appointments(spark: SparkSession, sf: str) -> DataFrame:
    """The booking log from CSV files, numbered, and the live bookings rebuilt from it."""
    log = seed.transactions(files.transaction_csv(spark, transaction_file(spark, sf), lines=True))
    return seed.appointments(log)


@query(
    "seed_patients",
    with_views("v_patient")
    + """SELECT CAST(row_number() OVER (ORDER BY patient_name) AS INT) AS patient_id, patient_name, address,
  phone_number, insurance_number, date_of_birth, gender, email FROM v_patient""",
)
def seed_patients(spark: SparkSession, sf: str) -> DataFrame:
    """Patients from CSV files, numbered in file order."""
    path = as_csv(spark.read.option("header", True).csv(patient_file(spark, sf)).orderBy("patientName"))
    return seed.patients(files.patient_csv(spark, path, lines=True))


@query(
    "seed_slots",
    with_views("v_slot")
    + """SELECT slot_id, doctor_id, slot_date, slot_code, 'AVAILABLE' AS slot_status, 'AVAILABLE' AS admin_status
FROM v_slot""",
)
def seed_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Slots from CSV files in which every line stands twice."""
    once = spark.read.option("header", True).csv(slot_file(spark, sf))
    return seed.slots(files.slot_csv(spark, as_csv(once.unionByName(once)), lines=True))


@query(
    "seed_records",
    with_views("v_record")
    + """SELECT 'REC26' || lpad(CAST(row_number() OVER (ORDER BY slot_id, version_number) AS STRING), 8, '0') AS record_id,
  slot_id, patient_id, version_number, diagnosis_note, prescription_note, created_at, created_at AS updated_at
FROM v_record""",
)
def seed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Medical records from CSV files, numbered in file order."""
    path = as_csv(record_rows(spark, sf).orderBy("slotID", "version"))
    return seed.records(files.record_csv(spark, path, lines=True))


@query(
    "raw_topic_view",
    """SELECT topic, 0 AS partition, event_id AS "offset", key,
  CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'view' THEN 'r' ELSE 'u' END AS op
FROM (SELECT event_id, event_type, 'clinic.public.doctor_slot' AS topic, 'S' || lpad(CAST(user_id AS STRING), 12, '0') AS key
  FROM events UNION ALL SELECT event_id, event_type, 'clinic.public.doctor', 'DR' || lpad(CAST(user_id AS STRING), 9, '0')
  FROM events)""",
)
def raw_topic_view(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of two topics side by side."""
    cfg = TABLES["doctor"]
    doctors = view(spark, sf, "v_doctor_change").withColumnRenamed("start_days", "start_working_date")
    both = slot_messages(spark, sf).unionByName(messages(doctors, cfg, cfg.topic()))
    return topics.raw_view(both).select(
        "topic", "partition", "offset", "key", F.get_json_object("document.payload", "$.op").alias("op")
    )
