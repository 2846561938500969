"""First load from CSV files: doctors, patients, slots, booking log, bookings, records."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotstream.operators import booking, mutations, schedule
from slotstream.session import build_session, drop_materialised, materialise
from slotstream.sources import files

# fixed values: prefixes and widths of generated keys
DOCTOR_ID = ("DR", 3)
RECORD_ID = ("REC26", 8)


def _numbered(
    rows: DataFrame, out: str, prefix: str | None = None, width: int = 0
) -> DataFrame:
    """Generated keys in file order. Equal lines stay apart: each has a place of its own."""
    placed = materialise(rows)
    made = mutations.with_sequence_ids(placed, files.LINE, out, prefix=prefix, width=width)
    made = made.drop(*files.LINE)
    return made if prefix else made.withColumn(out, F.col(out).cast("int"))


def doctors(rows: DataFrame) -> DataFrame:
    return _numbered(rows, "doctor_id", *DOCTOR_ID)


def patients(rows: DataFrame) -> DataFrame:
    return _numbered(rows, "patient_id")


def transactions(rows: DataFrame) -> DataFrame:
    return _numbered(rows, "transaction_id", booking.TRANSACTION_PREFIX, booking.TRANSACTION_WIDTH)


def appointments(log: DataFrame) -> DataFrame:
    """Bookings rebuilt from the log, replacing whatever the table held."""
    live = booking.rebuild_appointments(log)
    made = mutations.with_sequence_ids(live, ["booked_at", "booking_ref"], "appointment_id")
    return made.withColumn("appointment_id", F.col("appointment_id").cast("int"))


def _short_lines(rows: DataFrame) -> DataFrame:
    """The same places with the numbers of files, in order of their names, for the names, which would
    take more room than the rows."""
    names = rows.select(files.LINE[0]).distinct()
    numbers = names.withColumn("_at", F.row_number().over(W.orderBy(files.LINE[0])))
    placed = rows.join(F.broadcast(numbers), files.LINE[0])
    return placed.withColumn(files.LINE[0], F.col("_at")).select(*rows.columns)


def _without_conflicts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows an insert into an empty table takes that ignores conflicts: the first per key."""
    placed = _short_lines(rows)
    return mutations.insert_ignore(placed.limit(0), placed, keys, files.LINE)


def records(rows: DataFrame) -> DataFrame:
    once = _without_conflicts(rows, ["slot_id", "patient_id", "version_number"])
    return _numbered(once, "record_id", *RECORD_ID)


def slots(rows: DataFrame) -> DataFrame:
    return _without_conflicts(rows, ["slot_id"]).drop(*files.LINE)


def seed(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """All tables from the files `doctor, patient, doctor_slot, appointment_transaction, medical_record`."""
    log = transactions(files.transaction_csv(spark, paths["appointment_transaction"], lines=True))
    doctor_rows = doctors(files.doctor_csv(spark, paths["doctor"], lines=True))
    return {
        "slot_code_template": schedule.slot_template(spark),
        "calendar_day": schedule.calendar_days(spark),
        "doctor": doctor_rows,
        "doctor_insert_month": schedule.month_locks(doctor_rows),
        "patient": patients(files.patient_csv(spark, paths["patient"], lines=True)),
        "doctor_slot": slots(files.slot_csv(spark, paths["doctor_slot"], lines=True)),
        "appointment_transaction": log,
        "appointment": appointments(log),
        "medical_record": records(files.record_csv(spark, paths["medical_record"], lines=True)),
    }


SOURCES = ["doctor", "patient", "doctor_slot", "appointment_transaction", "medical_record"]


def write(tables: dict[str, DataFrame], root: str) -> None:
    """All tables as files below `root`, in place of what is there, so a rerun starts over. Slots
    are partitioned by month, as the monthly job reads and writes them."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if name == "doctor_slot":
            month = F.date_format("slot_date", "yyyy-MM")
            writer = df.withColumn("slot_month", month).write.mode("overwrite").partitionBy("slot_month")
        writer.parquet(f"{root.rstrip('/')}/{name}")


def main() -> None:
    """The nine tables of the application from CSV files."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--folder", required=True, help="has NAME.csv, or a folder of that name, for each input")
    parser.add_argument("--target", required=True)
    for name in SOURCES:
        parser.add_argument(f"--{name.replace('_', '-')}", help=f"default: FOLDER/{name}.csv")
    args = parser.parse_args()
    spark = build_session("first-load")
    folder = args.folder.rstrip("/")
    write(seed(spark, {n: getattr(args, n) or f"{folder}/{n}.csv" for n in SOURCES}), args.target)
    drop_materialised(spark)


if __name__ == "__main__":
    main()
