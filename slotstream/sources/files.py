"""CSV inputs with declared columns. Files start with a header row, maybe with a UTF-8 BOM.

With `lines` a loader also gives the `LINE` columns, by which rows can be put in file order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.functions import text
from slotstream.sources import quoted

# fixed values: synonyms of actions seen in demonstration files
ACTION_SYNONYMS = {"BOOK": "BOOKED", "CANCEL": "CANCELLED"}


# where a row stood: the file, the split that was read, and a number that grows within a split
LINE = ["_file", "_block", "_line"]


def _csv(
    spark: SparkSession, path: str, columns: list[str], *, multiline: bool = False, splits: bool = False
) -> DataFrame:
    """All columns as text, found by header name, and `LINE`; typing is left to the caller.

    Columns are found in one file's header; Spark then compares the header of every file with it,
    and a file with other columns or another order fails the read instead of mixing them up.
    Large files are read in splits, unless quoted fields may hold line breaks (`multiline`): then
    a file is read by one task, or in splits by `quoted` with `splits`.
    """
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
    schema = reader.csv(path).schema
    if splits:
        frame = quoted.table(spark, path, schema)
        places = [F.col(name) for name in LINE]
    else:
        frame = reader.schema(schema).option("enforceSchema", False).csv(path)
        places = [
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
        ]
    by_name = {name.lstrip("\ufeff").strip().lower(): name for name in schema.names}
    missing = [name for name in columns if name.lower() not in by_name]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; it has {schema.names}")
    return frame.select(
        *[text.blank_to_null(F.col(f"`{by_name[name.lower()]}`")).alias(name) for name in columns],
        *places,
    )


def _lines(wanted: bool) -> list[str]:
    return LINE if wanted else []


def doctor_csv(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    rows = _csv(spark, path, ["doctorName", "specialty", "StartWorkingDate"])
    return rows.select(
        F.col("doctorName").alias("doctor_name"),
        "specialty",
        text.parse_date(F.col("StartWorkingDate"), text.US_DATE).alias("start_working_date"),
        *_lines(lines),
    )


def patient_csv(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    rows = _csv(
        spark,
        path,
        ["patientName", "address", "phoneNumber", "insuranceNumber", "dateOfBirth", "gender", "email"],
    )
    born = F.col("dateOfBirth")
    return rows.select(
        F.col("patientName").alias("patient_name"),
        "address",
        text.zero_fill(F.col("phoneNumber"), 10).alias("phone_number"),
        F.col("insuranceNumber").alias("insurance_number"),
        F.coalesce(born.try_cast("date"), text.parse_date(born, text.US_DATE)).alias("date_of_birth"),
        "gender",
        "email",
        *_lines(lines),
    )


def slot_csv(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    rows = _csv(spark, path, ["slotID", "doctorID", "date", "slotCode"])
    day = F.col("date")
    return rows.select(
        F.col("slotID").alias("slot_id"),
        F.col("doctorID").alias("doctor_id"),
        F.coalesce(day.try_cast("date"), text.parse_date(day, text.US_DATE)).alias("slot_date"),
        F.col("slotCode").alias("slot_code"),
        F.lit("AVAILABLE").alias("slot_status"),
        F.lit("AVAILABLE").alias("admin_status"),
        *_lines(lines),
    )


def transaction_csv(
    spark: SparkSession, path: str, *, synonyms: bool = False, lines: bool = False
) -> DataFrame:
    """Booking log. With `synonyms`, book and cancel are read as BOOKED and CANCELLED."""
    rows = _csv(spark, path, ["slotID", "patientID", "status", "event_timestamp"])
    action = F.upper("status")
    if synonyms:
        for word, name in ACTION_SYNONYMS.items():
            action = F.when(F.upper("status") == word, F.lit(name)).otherwise(action)
    return rows.select(
        F.col("slotID").alias("slot_id"),
        F.col("patientID").try_cast("int").alias("patient_id"),
        action.alias("action"),
        text.parse_twelve_hour(F.col("event_timestamp")).alias("created_at"),
        *_lines(lines),
    )


def appointment_csv(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    rows = _csv(spark, path, ["booking_ref", "slotID", "patientID", "booked_at"])
    return rows.select(
        "booking_ref",
        F.col("slotID").alias("slot_id"),
        F.col("patientID").try_cast("int").alias("patient_id"),
        text.parse_twelve_hour(F.col("booked_at")).alias("booked_at"),
        *_lines(lines),
    )


def record_csv(
    spark: SparkSession, path: str, *, lines: bool = False, splits: bool = False
) -> DataFrame:
    """Medical records; the one time in the file fills both time columns.

    With `splits` large files are read by several tasks, for two writes of the lines in between."""
    columns = ["slotID", "patientID", "version", "diagnosis", "treatment", "updated_at"]
    rows = _csv(spark, path, columns, multiline=True, splits=splits)
    changed = F.col("updated_at").try_cast("timestamp")
    return rows.select(
        F.col("slotID").alias("slot_id"),
        F.col("patientID").try_cast("int").alias("patient_id"),
        F.col("version").try_cast("int").alias("version_number"),
        F.col("diagnosis").alias("diagnosis_note"),
        F.col("treatment").alias("prescription_note"),
        changed.alias("created_at"),
        changed.alias("updated_at"),
        *_lines(lines),
    )
