"""Queries on change messages: decoding, rejected messages, wire encodings, batch counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.checks.base import query
from slotstream.functions import wire
from slotstream.operators import cdc, quality
from slotstream.sources.registry import TABLES
from slotstream.testdata import messages, view, with_views

SLOT = TABLES["doctor_slot"]
TOPIC = SLOT.topic()


def slot_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The slot change log in wire types."""
    return view(spark, sf, "v_change").withColumnRenamed("slot_date_days", "slot_date")


def slot_messages(spark: SparkSession, sf: str) -> DataFrame:
    return messages(slot_changes(spark, sf), SLOT, TOPIC)


def decoded(df: DataFrame) -> DataFrame:
    return df.select(*SLOT.columns, "op", "is_deleted", "cdc_ts", "source_offset")


_ROW = """slot_id, {doctor} AS doctor_id, {date} AS slot_date, {code} AS slot_code, {status} AS slot_status,
  op, CASE WHEN op = 'd' THEN 1 ELSE 0 END AS is_deleted, date_trunc('second', ts) AS cdc_ts,
  kafka_offset AS source_offset"""
_DATE = "DATE '1970-01-01' + CAST(slot_date_days AS INT)"


@query(
    "cdc_decode",
    with_views("v_change")
    + "SELECT "
    + _ROW.format(doctor="doctor_id", date=_DATE, code="slot_code", status="slot_status")
    + " FROM v_change",
)
def cdc_decode(spark: SparkSession, sf: str) -> DataFrame:
    return decoded(cdc.decode(slot_messages(spark, sf), SLOT))


@query(
    "cdc_decode_delete",
    with_views("v_change")
    + "SELECT "
    + _ROW.format(
        doctor="CAST(NULL AS STRING)",
        date="CAST(NULL AS DATE)",
        code="CAST(NULL AS STRING)",
        status="CAST(NULL AS STRING)",
    )
    + " FROM v_change WHERE op = 'd'",
)
def cdc_decode_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Deletes whose before image holds the key alone."""
    rows = slot_changes(spark, sf)
    rest = [c for c in SLOT.columns if c != SLOT.pk]
    bare = rows.withColumns({c: F.when(F.col("op") != "d", F.col(c)) for c in rest})
    return decoded(cdc.decode(messages(bare, SLOT, TOPIC), SLOT)).filter("is_deleted = 1")


@query(
    "cdc_images",
    with_views("v_change")
    + f"""SELECT kafka_offset AS source_offset, {_DATE} AS row_date,
  coalesce({_DATE}, DATE '1970-01-01' + CAST(kafka_offset % 1000 AS INT)) AS column_date
FROM v_change WHERE op <> 'd'""",
)
def cdc_images(spark: SparkSession, sf: str) -> DataFrame:
    """Updates that set a column to NULL while the before image is complete, read both ways."""
    rows = slot_changes(spark, sf).filter("op <> 'd'")
    after = F.struct(*SLOT.columns)
    before = F.struct(
        "slot_id", "doctor_id", (F.col("kafka_offset") % 1000).alias("slot_date"), "slot_code", "slot_status"
    )
    payload = F.struct(
        before.alias("before"), after.alias("after"), "op", F.unix_millis("ts").alias("ts_ms")
    )
    raw = rows.select(
        F.to_json(F.struct(payload.alias("payload"))).alias("value"), F.col("kafka_offset").alias("offset")
    )
    by_column = cdc.decode(raw, SLOT).select("source_offset", F.col("slot_date").alias("column_date"))
    by_row = cdc.decode(raw, SLOT, image="row").select("source_offset", F.col("slot_date").alias("row_date"))
    return by_column.join(by_row, "source_offset")


_BAD = """CASE event_type WHEN 'view' THEN 'unparsable' WHEN 'click' THEN 'no_payload' WHEN 'purchase' THEN 'no_value'
  WHEN 'error' THEN 'no_payload' ELSE CASE WHEN user_id % 2 = 0 THEN 'null_key' END END"""


def damaged_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The event table as messages, most of them damaged in one way or another."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    row = F.struct(
        F.when(F.col("user_id") % 2 == 1, F.col("user_id").cast("string")).alias("slot_id"),
        F.lit("DR1").alias("doctor_id"),
    )
    good = F.to_json(F.struct(F.struct(row.alias("after"), F.lit("c").alias("op")).alias("payload")))
    value = (
        F.when(F.col("event_type") == "view", F.lit("not json"))
        .when(F.col("event_type") == "click", F.lit("{}"))
        .when(F.col("event_type") == "purchase", F.lit(None).cast("string"))
        .when(F.col("event_type") == "error", F.lit('{"payload":null}'))
        .otherwise(good)
    )
    return events.select(value.alias("value"), F.col("event_id").alias("offset"))


@query(
    "cdc_bad_rows",
    f"SELECT event_id AS source_offset, {_BAD} AS reason FROM events WHERE {_BAD} IS NOT NULL",
)
def cdc_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.rejected(damaged_messages(spark, sf), SLOT).select("source_offset", "reason")


@query(
    "batch_metrics",
    """SELECT count(*) AS total_rows, count(*) FILTER (WHERE user_id % 2 = 0) AS null_key_rows,
  count(*) FILTER (WHERE user_id % 2 = 1) AS clean_rows FROM events WHERE event_type = 'signup'""",
)
def batch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = cdc.decode(damaged_messages(spark, sf), SLOT, keep_null_keys=True)
    return quality.batch_metrics(rows, SLOT.pk)


@query(
    "cdc_days_date",
    """SELECT event_id, DATE '1970-01-01' + CAST(event_id * 7 - 20000 AS INT) AS day FROM events""",
)
def cdc_days_date(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    days = F.col("event_id") * 7 - 20000
    return events.select("event_id", wire.days_to_date(days).alias("day"))


_MICROS = "((event_id - 5000) * 123456789)"


@query(
    "cdc_micros_ts",
    f"""SELECT event_id, make_timestamp(CAST(trunc({_MICROS} / 1000000.0) AS BIGINT) * 1000000) AS whole,
  make_timestamp({_MICROS}) AS exact,
  make_timestamp(CAST(trunc({_MICROS} / 1000.0) AS BIGINT) * 1000) AS exact_millis FROM events""",
)
def cdc_micros_ts(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    micros = (F.col("event_id") - 5000) * 123456789
    millis = F.call_function("div", micros, F.lit(1000))
    return events.select(
        "event_id",
        wire.micros_to_ts(micros).alias("whole"),
        wire.micros_to_ts(micros, "full").alias("exact"),
        wire.millis_to_ts(millis, "full").alias("exact_millis"),
    )


@query(
    "cdc_time_of_day",
    """SELECT event_id, strftime(make_timestamp(event_id * 1800000000 % 86400000000), '%H:%M') AS clock FROM events""",
)
def cdc_time_of_day(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.read.parquet(f"{sf}/events.parquet")
    sent = (F.col("event_id") * F.lit(1800000000) % F.lit(86400000000)).cast("string")
    rows = events.select("event_id", sent.alias("clock"))
    return cdc.decode_time_of_day(rows, ["clock"])
