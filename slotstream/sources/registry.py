"""The captured tables: fields, wire encodings, keys and targets, all in one place.

A field is `(name, kind)`. The kind fixes how the value travels and which type it gets in
staging:

    text    string                      int     64-bit number, 32 bits in staging
    days    days since 1970-01-01       micros  microseconds since 1970-01-01
    clock   time of day, see `functions.wire.time_of_day`
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

WIRE_TYPES = {
    "text": T.StringType(),
    "clock": T.StringType(),
    "int": T.LongType(),
    "days": T.LongType(),
    "micros": T.LongType(),
}
STAGING_TYPES = {
    "text": T.StringType(),
    "clock": T.StringType(),
    "int": T.IntegerType(),
    "days": T.DateType(),
    "micros": T.TimestampType(),
}
DEFAULT_TOPIC_PREFIX = "clinic.public"


@dataclass(frozen=True)
class TableConfig:
    """One captured table."""

    name: str
    pk: str
    fields: tuple[tuple[str, str], ...]
    # columns whose current value is the latest one that is not NULL
    nullable: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def row_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, WIRE_TYPES[k], True) for n, k in self.fields])

    @property
    def staging_table(self) -> str:
        return f"stg_{self.name}"

    def topic(self, prefix: str = DEFAULT_TOPIC_PREFIX) -> str:
        return f"{prefix}.{self.name}"

    def checkpoint(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.staging_table}"


# fixed values: the captured tables' names, fields, keys and wire encodings
TABLES: dict[str, TableConfig] = {
    config.name: config
    for config in [
        TableConfig(
            "doctor",
            "doctor_id",
            (
                ("doctor_id", "text"),
                ("doctor_name", "text"),
                ("specialty", "text"),
                ("start_working_date", "days"),
            ),
            nullable=("start_working_date",),
        ),
        TableConfig(
            "patient",
            "patient_id",
            (
                ("patient_id", "int"),
                ("patient_name", "text"),
                ("address", "text"),
                ("phone_number", "text"),
                ("insurance_number", "text"),
                ("date_of_birth", "days"),
                ("gender", "text"),
                ("email", "text"),
                ("created_at", "micros"),
                ("updated_at", "micros"),
            ),
            nullable=("date_of_birth",),
        ),
        TableConfig(
            "slot_code_template",
            "slot_code",
            (
                ("slot_code", "text"),
                ("start_time", "clock"),
                ("end_time", "clock"),
                ("display_order", "int"),
            ),
            nullable=("display_order",),
        ),
        TableConfig(
            "doctor_slot",
            "slot_id",
            (
                ("slot_id", "text"),
                ("doctor_id", "text"),
                ("slot_date", "days"),
                ("slot_code", "text"),
                ("slot_status", "text"),
            ),
            nullable=("slot_date",),
        ),
        TableConfig(
            "appointment",
            "appointment_id",
            (
                ("appointment_id", "int"),
                ("booking_ref", "text"),
                ("slot_id", "text"),
                ("patient_id", "int"),
                ("booked_at", "micros"),
            ),
            nullable=("booked_at",),
        ),
        TableConfig(
            "appointment_transaction",
            "transaction_id",
            (
                ("transaction_id", "text"),
                ("slot_id", "text"),
                ("patient_id", "int"),
                ("action", "text"),
                ("created_at", "micros"),
            ),
            nullable=("created_at",),
        ),
        TableConfig(
            "medical_record",
            "record_id",
            (
                ("record_id", "text"),
                ("slot_id", "text"),
                ("patient_id", "int"),
                ("version_number", "int"),
                ("diagnosis_note", "text"),
                ("prescription_note", "text"),
                ("created_at", "micros"),
                ("updated_at", "micros"),
            ),
        ),
    ]
}

# fixed values: fields of a notification message
NOTIFICATION_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType() if name == "patient_id" else T.StringType(), True)
        for name in [
            "notification_key",
            "transaction_id",
            "slot_id",
            "patient_id",
            "action",
            "event_type",
            "event_time",
            "channel",
        ]
    ]
)

# every table of the warehouse: 7 staging, 4 dimensions, 4 facts, 7 current views
WAREHOUSE_TABLES = (
    [config.staging_table for config in TABLES.values()]
    + ["dim_doctor", "dim_patient", "dim_slot_code", "dim_doctor_slot"]
    + ["fact_appointment", "fact_appointment_transaction", "fact_slot_daily", "fact_medical_record"]
    + [f"vw_dim_{name}_current" for name in ("doctor", "patient", "slot_code", "doctor_slot")]
    + [f"vw_fact_{name}_current" for name in ("appointment", "slot_daily", "medical_record")]
)
