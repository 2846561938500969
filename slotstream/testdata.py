"""Clinic tables as views over the generated test tables.

Each view is one SELECT that Spark and DuckDB both understand, with `{table}` where a test
table is read. Keys are derived by rules that grow with the data. Every view covers its whole
table but `v_appointment`: an order is a slot, and those of status F are the booked ones.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.operators import cdc, schedule
from slotstream.sources.registry import TableConfig

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _slot(number: str) -> str:
    return f"'S' || lpad(CAST({number} AS STRING), 12, '0')"


def _doctor(number: str) -> str:
    return f"'DR' || lpad(CAST({number} AS STRING), 9, '0')"


_CODES = ", ".join(f"('{c}', '{a}', '{b}', {n})" for c, a, b, n in schedule.SLOT_TEMPLATE)
_ACTION = """CASE event_type WHEN 'click' THEN 'BOOKED' WHEN 'view' THEN 'CONFIRMED'
    WHEN 'error' THEN 'CANCELLED' WHEN 'purchase' THEN 'COMPLETED' ELSE 'NO_SHOW' END"""

_OP = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'view' THEN 'r' ELSE 'u' END"

# view: (views it reads, SELECT)
VIEWS: dict[str, tuple[list[str], str]] = {
    "v_slot_code": (
        [],
        f"SELECT * FROM (VALUES {_CODES}) AS t(slot_code, start_time, end_time, display_order)",
    ),
    "v_doctor": (
        [],
        f"""SELECT {_doctor('s_suppkey')} AS doctor_id, s_name AS doctor_name, n_name AS specialty,
    CASE WHEN s_suppkey % 7 = 0 THEN NULL
         ELSE DATE '2015-01-01' + CAST(s_suppkey % 3000 AS INT) END AS start_working_date
  FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey""",
    ),
    "v_patient": (
        [],
        """SELECT CAST(c_custkey + 1 AS INT) AS patient_id, c_name AS patient_name,
    c_mktsegment AS address, '0' || lpad(CAST(c_custkey AS STRING), 9, '0') AS phone_number,
    CASE c_nationkey % 4 WHEN 0 THEN 'GD' WHEN 1 THEN 'DN' WHEN 2 THEN 'CH' ELSE 'QN' END
      || lpad(CAST(c_custkey AS STRING), 13, '0') AS insurance_number,
    DATE '1950-01-01' + CAST(c_custkey % 20000 AS INT) AS date_of_birth,
    CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
    CASE WHEN c_custkey % 10 = 0 THEN NULL
         ELSE 'p' || CAST(c_custkey AS STRING) || '@example.org' END AS email
  FROM {customer}""",
    ),
    "v_slot": (
        ["v_slot_code"],
        f"""SELECT {_slot('o_orderkey')} AS slot_id,
    {_doctor('o_orderkey % (SELECT count(*) FROM {supplier})')} AS doctor_id,
    CAST(o_orderdate AS DATE) AS slot_date, slot_code,
    CASE o_orderstatus WHEN 'O' THEN 'AVAILABLE' WHEN 'F' THEN 'BOOKED' ELSE 'BLOCKED' END AS slot_status,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'BLOCKED' ELSE 'AVAILABLE' END AS admin_status
  FROM {{orders}} JOIN v_slot_code ON display_order = o_orderkey % 16 + 1""",
    ),
    # all orders as the slots of one month, April 2026
    "v_slot_month": (
        ["v_slot_code"],
        f"""SELECT 'M' || {_slot('o_orderkey')} AS slot_id,
    {_doctor('o_orderkey % (SELECT count(*) FROM {supplier})')} AS doctor_id,
    DATE '2026-04-01' + CAST(floor(o_orderkey / 7) % 30 AS INT) AS slot_date, slot_code,
    CASE o_orderstatus WHEN 'O' THEN 'AVAILABLE' WHEN 'F' THEN 'BOOKED' ELSE 'BLOCKED' END AS slot_status,
    'AVAILABLE' AS admin_status
  FROM {{orders}} JOIN v_slot_code ON display_order = floor(o_orderkey / 3) % 16 + 1""",
    ),
    "v_appointment": (
        [],
        f"""SELECT CAST(o_orderkey AS INT) AS appointment_id,
    'TXN26' || lpad(CAST(o_orderkey AS STRING), 12, '0') AS booking_ref,
    {_slot('o_orderkey')} AS slot_id, CAST(o_custkey + 1 AS INT) AS patient_id,
    CAST(o_orderdate AS TIMESTAMP) AS booked_at
  FROM {{orders}} WHERE o_orderstatus = 'F'""",
    ),
    # about four entries per slot, spread over time
    "v_txn": (
        [],
        f"""SELECT event_id, 'TXN26' || lpad(CAST(event_id AS STRING), 12, '0') AS transaction_id,
    {_slot('event_id % (SELECT CAST(floor(count(*) / 4) AS BIGINT) + 1 FROM {events})')} AS slot_id,
    CAST(user_id + 1 AS INT) AS patient_id, {_ACTION} AS action, CAST(ts AS TIMESTAMP) AS created_at
  FROM {{events}}""",
    ),
    "v_record": (
        [],
        f"""SELECT 'REC26' || lpad(CAST(conv_id * 10 + turn AS STRING), 12, '0') AS record_id,
    {_slot('conv_id')} AS slot_id,
    CAST(conv_id % (SELECT count(*) FROM {{customer}}) + 1 AS INT) AS patient_id,
    CAST(turn + 1 AS INT) AS version_number, text AS diagnosis_note,
    CASE WHEN role = 'assistant' THEN text END AS prescription_note,
    CAST(DATE '2024-01-01' + CAST(turn AS INT) AS TIMESTAMP) AS created_at
  FROM {{conversations}}""",
    ),
    # booking requests: some slots wanted by several, some unknown, some left out
    "v_request": (
        [],
        f"""SELECT event_id AS request_id,
    CASE WHEN user_id % 50 = 0 THEN NULL WHEN user_id % 50 = 1 THEN 'X' || CAST(event_id AS STRING)
         ELSE {_slot('CAST(floor(event_id / 16) AS BIGINT) * 16')} END AS slot_id,
    CAST(user_id + 1 AS INT) AS patient_id, CAST(ts AS TIMESTAMP) AS requested_at
  FROM {{events}}""",
    ),
    # cancellation requests: the booking patient's number on odd orders, another's on even ones
    "v_cancel_request": (
        ["v_patient"],
        f"""SELECT o_orderkey AS request_id, {_slot('o_orderkey')} AS slot_id, insurance_number,
    CAST(o_orderdate AS TIMESTAMP) AS requested_at
  FROM {{orders}} JOIN v_patient ON patient_id = CAST(
    CASE WHEN o_orderkey % 2 = 1 THEN o_custkey ELSE 0 END + 1 AS INT)""",
    ),
    # slot updates asked for by doctors: existing slots and new places
    "v_update": (
        ["v_slot_code"],
        f"""SELECT o_orderkey AS update_id,
    {_doctor('o_orderkey % (SELECT count(*) FROM {supplier})')} AS doctor_id,
    CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS INT) AS slot_date,
    slot_code,
    CASE o_orderpriority WHEN '2-HIGH' THEN 'BLOCKED' WHEN '3-MEDIUM' THEN 'BOOKED' ELSE 'AVAILABLE' END
      AS status,
    CAST(o_orderdate AS TIMESTAMP) AS requested_at
  FROM {{orders}} JOIN v_slot_code ON display_order = o_orderkey % 16 + 1""",
    ),
    # the days of the slots, with their calendar status
    "v_calendar": (
        [],
        """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
    CASE WHEN extract(MONTH FROM o_orderdate) = 1 AND extract(DAY FROM o_orderdate) = 1 THEN 'HOLIDAY'
         WHEN extract(MONTH FROM o_orderdate) = 4 AND extract(DAY FROM o_orderdate) = 30 THEN 'HOLIDAY'
         WHEN extract(MONTH FROM o_orderdate) = 5 AND extract(DAY FROM o_orderdate) = 1 THEN 'HOLIDAY'
         WHEN CAST(date_trunc('week', CAST(o_orderdate AS DATE) + 1) AS DATE) = CAST(o_orderdate AS DATE) + 1 THEN 'WEEKEND'
         ELSE 'NORMAL_DAY' END AS status
  FROM {orders}""",
    ),
    # change log of slots: many versions per key
    "v_change": (
        [],
        f"""SELECT event_id AS kafka_offset, {_slot('user_id')} AS slot_id,
    {_doctor('event_id % 10')} AS doctor_id,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(19000 + event_id % 365 AS BIGINT) END AS slot_date_days,
    CASE WHEN event_id % 2 = 0 THEN '8A' ELSE '16B' END AS slot_code,
    CASE event_type WHEN 'view' THEN 'AVAILABLE' WHEN 'click' THEN 'BOOKED' WHEN 'purchase' THEN 'BLOCKED'
      ELSE 'CANCELLED' END AS slot_status,
    {_OP} AS op, CAST(ts AS TIMESTAMP) AS ts
  FROM {{events}}""",
    ),
    "v_doctor_change": (
        [],
        f"""SELECT event_id AS kafka_offset, {_doctor('user_id')} AS doctor_id,
    'Doctor ' || CAST(event_id AS STRING) AS doctor_name, event_type AS specialty,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE 16000 + event_id % 3000 END AS start_days, {_OP} AS op,
    CAST(ts AS TIMESTAMP) AS ts
  FROM {{events}}""",
    ),
    "v_patient_change": (
        [],
        f"""SELECT event_id AS kafka_offset, user_id + 1 AS patient_id,
    'Patient ' || CAST(event_id AS STRING) AS patient_name, event_type AS address,
    '0' || lpad(CAST(event_id AS STRING), 9, '0') AS phone_number,
    'GD' || lpad(CAST(user_id AS STRING), 13, '0') AS insurance_number,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id % 9000 - 4000 END AS birth_days,
    CASE WHEN event_id % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'p' || CAST(event_id AS STRING) || '@example.org' END AS email,
    {_OP} AS op, CAST(ts AS TIMESTAMP) AS ts
  FROM {{events}}""",
    ),
    # a change log with sixteen keys only, so every key is a hot one
    "v_slot_code_change": (
        ["v_slot_code"],
        f"""SELECT event_id AS kafka_offset, slot_code, start_time, end_time,
    CASE WHEN event_id % 6 = 0 THEN NULL ELSE display_order + event_id % 3 END AS display_order, {_OP} AS op,
    CAST(ts AS TIMESTAMP) AS ts
  FROM {{events}} JOIN v_slot_code ON display_order = user_id % 16 + 1""",
    ),
    # first versions of all slots, followed by the change log
    "v_slot_version": (
        ["v_slot", "v_change"],
        """SELECT slot_id, doctor_id, slot_date, slot_code, slot_status, 'r' AS op,
    TIMESTAMP '2023-01-01 00:00:00' AS cdc_ts, CAST(-1 AS BIGINT) AS source_offset FROM v_slot
  UNION ALL
  SELECT slot_id, doctor_id, DATE '1970-01-01' + CAST(slot_date_days AS INT), slot_code, slot_status, op,
    date_trunc('second', ts), kafka_offset FROM v_change""",
    ),
    # booking log as staged; some entries name slots nobody knows
    "v_txn_version": (
        ["v_txn"],
        """SELECT transaction_id, CASE WHEN event_id % 11 = 0 THEN 'X' || slot_id ELSE slot_id END AS slot_id,
    patient_id, action, created_at, CASE WHEN event_id % 13 = 0 THEN 'd' ELSE 'c' END AS op,
    date_trunc('second', created_at) AS cdc_ts, event_id AS source_offset
  FROM v_txn""",
    ),
    # bookings as staged, many versions per key
    "v_appointment_version": (
        [],
        f"""SELECT CAST(user_id AS INT) AS appointment_id, 'B' || CAST(event_id AS STRING) AS booking_ref,
    {_slot('event_id')} AS slot_id, CAST(user_id + 1 AS INT) AS patient_id,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS booked_at, {_OP} AS op,
    date_trunc('second', CAST(ts AS TIMESTAMP)) AS cdc_ts, event_id AS source_offset
  FROM {{events}}""",
    ),
    # medical records as staged: the turns of a conversation are versions of one record
    "v_record_version": (
        ["v_record"],
        """SELECT 'REC' || slot_id AS record_id, slot_id, patient_id, version_number, diagnosis_note,
    prescription_note, CASE WHEN version_number = 3 THEN 'd' ELSE 'u' END AS op, created_at AS cdc_ts,
    CAST(version_number AS BIGINT) AS source_offset
  FROM v_record""",
    ),
}


def sql(name: str) -> str:
    """The view's SELECT with test table names in braces."""
    return VIEWS[name][1]


def _closure(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []
    for name in names:
        for needed in (*_closure(tuple(VIEWS[name][0])), name):
            if needed not in out:
                out.append(needed)
    return out


def with_views(*names: str) -> str:
    """`WITH` clause holding the views, for DuckDB where the test tables are views by name."""
    plain = {t: t for t in TABLES}
    return "WITH " + ",\n".join(f"{n} AS ({sql(n).format(**plain)})" for n in _closure(names))


def _table(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Name of a temporary view of a test table, whose files are looked up only once."""
    name = f"t{zlib.crc32(sf_dir.encode()):08x}_{table}"
    if not spark.catalog.tableExists(name):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(name)
    return name


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A clinic table as a DataFrame."""
    needed = _closure((name,))
    used = {t for t in TABLES if any(f"{{{t}}}" in sql(n) for n in needed)}
    names = {t: _table(spark, sf_dir.rstrip("/"), t) for t in used}
    head = ",\n".join(f"{n} AS ({sql(n).format(**names)})" for n in needed[:-1])
    body = sql(name).format(**names)
    return spark.sql(f"WITH {head}\n{body}" if head else body)


def messages(changes: DataFrame, cfg: TableConfig, topic: str) -> DataFrame:
    """Change rows `(<table columns in wire types>, op, ts, kafka_offset)` as topic messages."""
    value = cdc.encode(changes, cfg, op=F.col("op"), ts_ms=F.unix_millis("ts"))
    return changes.select(
        F.col(cfg.pk).cast("string").alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
