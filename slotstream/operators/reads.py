"""Read queries of the booking application as DataFrame functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotstream.functions import text


def by_key(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows with one key; the predicate reaches the scan."""
    return df.filter(F.col(column) == F.lit(value))


def ordered(df: DataFrame, order: list[str]) -> DataFrame:
    """The whole table in order."""
    return df.orderBy(*order)


def doctors_by_specialty(doctors: DataFrame, specialty: str) -> DataFrame:
    return doctors.filter(F.col("specialty") == specialty).select("doctor_id", "doctor_name", "specialty")


def specialties(doctors: DataFrame) -> DataFrame:
    return doctors.select("specialty").distinct()


def insurance_numbers(patients: DataFrame) -> DataFrame:
    return (
        patients.filter(F.col("insurance_number").isNotNull())
        .select("insurance_number")
        .orderBy("insurance_number")
    )


def patient_appointments(
    appointments: DataFrame, slots: DataFrame, patient_id: int | None = None
) -> DataFrame:
    """Bookings of one patient, or of all, by date and slot code (in text order)."""
    rows = appointments if patient_id is None else by_key(appointments, "patient_id", patient_id)
    joined = rows.select("patient_id", "slot_id", "booking_ref", "booked_at").join(
        slots.select("slot_id", "doctor_id", "slot_date", "slot_code"), "slot_id"
    )
    out = joined.select("patient_id", "doctor_id", "slot_date", "slot_code", "booking_ref", "booked_at")
    return out.orderBy("patient_id", "slot_date", "slot_code", "booking_ref")


def doctor_appointments(
    appointments: DataFrame, slots: DataFrame, doctor_id: str | None = None
) -> DataFrame:
    """Bookings of one doctor, or of all, by date and slot code (in text order)."""
    mine = slots if doctor_id is None else by_key(slots, "doctor_id", doctor_id)
    joined = appointments.select("patient_id", "slot_id").join(
        mine.select("slot_id", "doctor_id", "slot_date", "slot_code"), "slot_id"
    )
    out = joined.select("doctor_id", "patient_id", "slot_id", "slot_date", "slot_code")
    return out.orderBy("doctor_id", "slot_date", "slot_code", "slot_id")


def history(appointments: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Joined bookings, of one day if given."""
    return appointments if day is None else appointments.filter(F.col("slot_date") == F.lit(day))


def page(df: DataFrame, order: list[str | Column], number: int, size: int = 5) -> DataFrame:
    """Page `number` (from 1) of the rows in `order`."""
    if number < 1 or size < 1:
        raise ValueError("pages and page sizes start at 1")
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, order: list[str], last: tuple | None = None, size: int = 5) -> DataFrame:
    """The rows in `order` that follow the row whose `order` columns are `last`, or the first.

    Unlike `page` it holds `size` rows however far on it is, and the bound reaches the scan. The
    `order` columns must be total and not NULL."""
    if size < 1:
        raise ValueError("page sizes start at 1")
    rows = df
    if last is not None:
        first = F.col(order[0])
        rows = rows.filter(first >= F.lit(last[0])).filter(
            F.struct(*order)
            > F.struct(
                *[
                    F.lit(v).cast(df.schema[c].dataType).alias(c)
                    for c, v in zip(order, last, strict=True)
                ]
            )
        )
    return rows.orderBy(*order).limit(size)


def page_count(df: DataFrame, size: int = 5) -> DataFrame:
    """The number of pages, as one row."""
    return df.agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("long").alias("pages"))


def search(df: DataFrame, keyword: str, columns: list[str]) -> DataFrame:
    """Rows where any of the columns contains the keyword, ignoring case."""
    return df.filter(text.contains_any([F.col(c) for c in columns], keyword))
