"""Queries on constraints and registration rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.checks.base import query
from slotstream.operators import quality
from slotstream.testdata import view, with_views


@query(
    "quality_duplicates",
    with_views("v_slot")
    + """SELECT doctor_id, slot_date, slot_code, count(*) AS n FROM v_slot
GROUP BY doctor_id, slot_date, slot_code HAVING count(*) > 1""",
)
def quality_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicates(view(spark, sf, "v_slot"), ["doctor_id", "slot_date", "slot_code"])


@query(
    "quality_orphans",
    with_views("v_txn_version", "v_slot")
    + "SELECT transaction_id, slot_id FROM v_txn_version WHERE slot_id NOT IN (SELECT slot_id FROM v_slot)",
)
def quality_orphans(spark: SparkSession, sf: str) -> DataFrame:
    log = view(spark, sf, "v_txn_version").select("transaction_id", "slot_id")
    return quality.orphans(log, "slot_id", view(spark, sf, "v_slot"), "slot_id")


@query(
    "quality_domain",
    with_views("v_change")
    + "SELECT kafka_offset, slot_status FROM v_change WHERE slot_status NOT IN ('AVAILABLE', 'BLOCKED')",
)
def quality_domain(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "v_change").select("kafka_offset", "slot_status")
    return quality.domain(rows, "slot_status", ["AVAILABLE", "BLOCKED"])


@query(
    "quality_check",
    with_views("v_record") + "SELECT record_id, version_number FROM v_record WHERE NOT version_number < 3",
)
def quality_check(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "v_record").select("record_id", "version_number")
    return quality.check(rows, F.col("version_number") < 3)


@query(
    "quality_nulls",
    with_views("v_patient_change")
    + """SELECT 'patient_name' AS column_name, count(*) FILTER (WHERE patient_name IS NULL) AS nulls FROM v_patient_change
UNION ALL SELECT 'email', count(*) FILTER (WHERE email IS NULL) FROM v_patient_change
UNION ALL SELECT 'birth_days', count(*) FILTER (WHERE birth_days IS NULL) FROM v_patient_change""",
)
def quality_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return quality.not_null(view(spark, sf, "v_patient_change"), ["patient_name", "email", "birth_days"])


@query(
    "registration_checks",
    with_views("v_patient", "v_appointment")
    + """, reg AS (SELECT patient_id, CASE WHEN patient_id % 5 = 0 THEN '1' ELSE '' END || phone_number AS phone,
    CASE WHEN patient_id % 7 = 0 THEN 'no mail' ELSE email END AS email, left(insurance_number, 2) AS insurance_prefix,
    CASE WHEN patient_id % 11 = 0 THEN substr(insurance_number, 4) ELSE substr(insurance_number, 3) END AS insurance_digits,
    CASE WHEN patient_id % 4 = 0 THEN 'other' ELSE gender END AS gender,
    CASE WHEN patient_id % 9 = 0 THEN DATE '2020-05-05' ELSE date_of_birth END AS date_of_birth FROM v_patient),
taken AS (SELECT p.insurance_number FROM v_patient p WHERE patient_id IN (SELECT patient_id FROM v_appointment)
  AND gender = 'male')
SELECT *, insurance_prefix || insurance_digits AS insurance_number, CASE
  WHEN NOT regexp_full_match(phone, '0[0-9]{9}') THEN 'Phone must be 10 digits and start with 0'
  WHEN email IS NULL OR NOT regexp_full_match(email, '[^ @]+@[^ @]+\\.[^ @]+') THEN 'Invalid email'
  WHEN NOT regexp_full_match(insurance_digits, '[0-9]{13}') THEN 'Insurance number must be 13 digits'
  WHEN insurance_prefix || insurance_digits IN (SELECT insurance_number FROM taken) THEN 'Insurance already exists'
  WHEN gender NOT IN ('male', 'female') THEN 'Gender must be male or female'
  WHEN year(date_of_birth) > 2016 THEN 'DOB must be before 2016' END AS reject_reason FROM reg""",
)
def registration_checks(spark: SparkSession, sf: str) -> DataFrame:
    """All patients register again, some with faults, while booked men are registered already."""
    patients = view(spark, sf, "v_patient")
    number, pid = F.col("insurance_number"), F.col("patient_id")
    registrations = patients.select(
        "patient_id",
        F.concat(F.when(pid % 5 == 0, F.lit("1")).otherwise(F.lit("")), "phone_number").alias("phone"),
        F.when(pid % 7 == 0, F.lit("no mail")).otherwise(F.col("email")).alias("email"),
        F.substring(number, 1, 2).alias("insurance_prefix"),
        F.when(pid % 11 == 0, F.substring(number, 4, 20)).otherwise(F.substring(number, 3, 20)).alias("insurance_digits"),
        F.when(pid % 4 == 0, F.lit("other")).otherwise(F.col("gender")).alias("gender"),
        F.when(pid % 9 == 0, F.lit(dt.date(2020, 5, 5))).otherwise(F.col("date_of_birth")).alias("date_of_birth"),
    )
    registered = patients.filter("gender = 'male'").join(
        view(spark, sf, "v_appointment").select("patient_id"), "patient_id", "left_semi"
    )
    return quality.registration_checks(registrations, registered, F.lit(dt.date(2026, 6, 1)))
