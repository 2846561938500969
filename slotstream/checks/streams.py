"""Queries that run a stream over the event table until it is used up, and read what it wrote."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.checks.base import ORACLES, query
from slotstream.checks.change_data import SLOT, damaged_messages, decoded
from slotstream.checks.notifications import AUDIT_SQL, NOW, SINCE, moment, references
from slotstream.checks.warehouse import FACT_APPOINTMENT
from slotstream.operators import notify, warehouse
from slotstream.operators.numbering import number_rows
from slotstream.plans import follow
from slotstream.plans import warehouse as plan
from slotstream.session import materialise, names_in, run_dir
from slotstream.sinks import ledger, writers
from slotstream.sources import topics
from slotstream.sources.registry import TABLES
from slotstream.streaming import bookings, first_events, notifications, progress, staging
from slotstream.testdata import VIEWS, messages, sql, view, with_views

LOG = TABLES["appointment_transaction"]


def streamed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A view over the event table with the event table read as a stream."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet*").parquet(sf)
    source.createOrReplaceTempView("events_stream")
    # a count of the whole table inside the view stays a batch read
    counted = f"FROM parquet.`{sf}/events.parquet`) AS STRING"
    head = ",\n".join(f"{n} AS ({sql(n)})" for n in VIEWS[name][0])
    text = (f"WITH {head}\n" if head else "") + sql(name)
    return spark.sql(text.replace("FROM {events}) AS STRING", counted).format(events="events_stream"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(writers.BATCH)


@query("stream_cdc_staging", ORACLES["cdc_decode"])
def stream_cdc_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Change stream to the staging table."""
    root = run_dir(spark, "staging")
    changes = streamed(spark, sf, "v_change").withColumnRenamed("slot_date_days", "slot_date")
    stream = staging.table_stream(
        messages(changes, SLOT, SLOT.topic()), SLOT, staging.stage_only(SLOT, root), f"{root}/checkpoints"
    )
    staging.run_all([stream], once=True)
    return decoded(read_batches(spark, f"{root}/{SLOT.staging_table}"))


@query("stream_warehouse", ORACLES["dim_current_slot"])
def stream_warehouse(spark: SparkSession, sf: str) -> DataFrame:
    """Change stream to staging and dimension; the current view over what arrived."""
    root = run_dir(spark, "warehouse")
    changes = streamed(spark, sf, "v_change").withColumnRenamed("slot_date_days", "slot_date")
    stream = staging.table_stream(
        messages(changes, SLOT, SLOT.topic()), SLOT, staging.stage_and_build(SLOT, root), f"{root}/checkpoints"
    )
    staging.run_all([stream], once=True)
    return warehouse.current(read_batches(spark, f"{root}/dim_doctor_slot"), "dim_doctor_slot")


_DEDUP_SQL = (
    with_views("v_txn_version")
    + f"""SELECT transaction_id AS notification_key, transaction_id, slot_id, patient_id, action,
  CASE action WHEN 'BOOKED' THEN 'BOOKING_CONFIRMATION' ELSE 'BOOKING_CANCELLATION' END AS event_type,
  strftime(date_trunc('second', created_at), '%Y-%m-%dT%H:%M:%S.000Z') AS event_time, 'EMAIL' AS channel
FROM v_txn_version WHERE op <> 'd' AND action IN ('BOOKED', 'CANCELLED')
  AND date_trunc('second', created_at) >= TIMESTAMP '{SINCE}'"""
)


@query("stream_notify_dedup", _DEDUP_SQL)
def stream_notify_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every change of the booking log arrives twice; one notification message each goes out."""
    root = run_dir(spark, "notifications")
    log = streamed(spark, sf, "v_txn_version").withColumnsRenamed(
        {"created_at": "ts", "source_offset": "kafka_offset"}
    )
    twice = log.withColumn("created_at", F.unix_micros("ts")).withColumn(
        "_copy", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    events = notifications.event_stream(messages(twice, LOG, LOG.topic()), moment(SINCE))
    writer = writers.topic_writer(
        events, notifications.TOPIC, checkpoint=f"{root}/checkpoint", fmt="parquet", path=f"{root}/topic"
    )
    staging.run_all([writer], once=True)
    return topics.notifications(
        topics.batch(spark, notifications.TOPIC, fmt="parquet", path=f"{root}/topic")
    )


@query(
    "stream_audit",
    AUDIT_SQL.replace("(SELECT notification_key FROM audit WHERE send_status = 'SENT')", "(SELECT '')"),
)
def stream_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Notification events as a stream, settled in the outbox; the audit trail."""
    root = run_dir(spark, "outbox")
    log = streamed(spark, sf, "v_txn_version").withColumn(
        "is_deleted", F.when(F.col("op") == "d", 1).otherwise(0)
    )
    events = notify.to_messages(notify.booking_events(log, moment(SINCE)))
    write = notifications.outbox_writer(root, lambda s: references(s, sf), now=moment(NOW))
    stream = notifications.outbox_stream(topics.notifications(events), write, f"{root}/checkpoint")
    staging.run_all([stream], once=True)
    pending = read_batches(spark, f"{root}/audit_pending")
    return pending.unionByName(read_batches(spark, f"{root}/audit"))


def topic_files(df: DataFrame, path: str, batches: int) -> None:
    """Messages as a file topic, mixed, in as many files for each of `batches` as tasks run at once."""
    files = batches * df.sparkSession.sparkContext.defaultParallelism
    df.repartition(files, "key", "offset").write.parquet(path)


def file_stream(spark: SparkSession, topic: str, path: str, batches: int) -> DataFrame:
    """The files of a topic in `batches` micro-batches."""
    files = sum(name.endswith(".parquet") for name in names_in(spark, path))
    options = {"maxFilesPerTrigger": str(max(1, -(-files // batches)))}
    return topics.stream(spark, topic, fmt="parquet", path=path, options=options)


@query("stream_notify_late", _DEDUP_SQL)
def stream_notify_late(spark: SparkSession, sf: str) -> DataFrame:
    """The booking log in three micro-batches, the newest third first: every first event of a
    transaction goes out, however late it is."""
    root = run_dir(spark, "late")
    log = view(spark, sf, "v_txn_version").withColumnsRenamed(
        {"created_at": "ts", "source_offset": "kafka_offset"}
    )
    log = log.withColumn("created_at", F.unix_micros("ts"))
    bounds = log.agg(F.percentile_approx("kafka_offset", [0.33, 0.66])).first()[0]
    offset = F.col("kafka_offset")
    parts = [offset > bounds[1], (offset > bounds[0]) & (offset <= bounds[1]), offset <= bounds[0]]
    sent = f"{root}/topic"
    for part in parts:
        batch = messages(log.filter(part), LOG, LOG.topic())
        batch.write.mode("append").parquet(f"{root}/log")
        # all files that are new are one micro-batch, however many there are
        source = topics.stream(spark, LOG.topic(), fmt="parquet", path=f"{root}/log")
        writer = writers.topic_writer(
            notifications.event_stream(source, moment(SINCE)),
            notifications.TOPIC,
            checkpoint=f"{root}/checkpoint",
            fmt="parquet",
            path=sent,
        )
        staging.run_all([writer], once=True)
    return topics.notifications(topics.batch(spark, notifications.TOPIC, fmt="parquet", path=sent))


_FATE = """CASE event_type WHEN 'view' THEN 'unparsable' WHEN 'click' THEN 'no_payload' WHEN 'purchase' THEN 'no_value'
  WHEN 'error' THEN 'no_payload' ELSE CASE WHEN user_id % 2 = 0 THEN 'null_key' WHEN user_id % 4 = 1 THEN 'bad_number'
  ELSE 'staged' END END"""


@query("stream_rejected", f"SELECT event_id AS source_offset, {_FATE} AS fate FROM events")
def stream_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged and sound messages through the staging and the reject stream: each is in one of them."""
    root = run_dir(spark, "rejected")
    rejects_run(spark, sf, root)
    staged = read_batches(spark, f"{root}/{SLOT.staging_table}")
    lost = spark.read.parquet(f"{root}/rejects")
    return staged.select("source_offset", F.lit("staged").alias("fate")).unionByName(
        lost.select("source_offset", F.col("reason").alias("fate"))
    )


def rejects_run(spark: SparkSession, sf: str, root: str) -> None:
    """Both streams over all damaged and sound messages, in two batches."""
    far = F.get_json_object("value", "$.payload").isNotNull() & (F.col("user_id") % 4 == 1)
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("event_id").alias("offset"), "user_id"
    )
    raw = damaged_messages(spark, sf).join(events, "offset")
    day = F.when(far, F.lit(10**12)).otherwise(F.lit(19000))
    value = F.when(
        far | (F.col("user_id") % 4 == 3),
        F.regexp_replace("value", F.lit('"doctor_id":'), F.concat(F.lit('"slot_date":'), day, F.lit(',"doctor_id":'))),
    ).otherwise(F.col("value"))
    whole = raw.select(
        F.lit("k").alias("key"),
        value.alias("value"),
        F.lit(SLOT.topic()).alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.current_timestamp().alias("timestamp"),
    )
    topic_files(whole, f"{root}/topic", 2)
    rows = staging.table_stream(
        file_stream(spark, SLOT.topic(), f"{root}/topic", 2), SLOT, staging.stage_only(SLOT, root), f"{root}/checkpoints"
    )
    rejects = staging.rejected_stream(
        file_stream(spark, SLOT.topic(), f"{root}/topic", 2), SLOT, f"{root}/rejects", f"{root}/checkpoints"
    )
    staging.run_all([rows, rejects], once=True)


@query(
    "stream_reject_rates",
    f"""SELECT 'rejected_doctor_slot' AS query, CAST(2 AS BIGINT) AS n_batches, count(*) AS input_rows,
  count(*) FILTER (WHERE fate <> 'staged') AS rejected_rows FROM (SELECT {_FATE} AS fate FROM events)""",
)
def stream_reject_rates(spark: SparkSession, sf: str) -> DataFrame:
    """What the log of batches says of the same messages, against the rejects themselves."""
    root = run_dir(spark, "rates")
    with progress.BatchLog(spark, f"{root}/log"):
        rejects_run(spark, sf, root)
    # a last batch without messages is told too
    log = progress.batches(spark, f"{root}/log").filter(
        (F.col("query") == "rejected_doctor_slot") & (F.col("input_rows") > 0)
    )
    return log.groupBy("query").agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("rejected_rows").alias("rejected_rows"),
    )


@query("ledger_repeated_batches", with_views("v_txn") + "SELECT transaction_id, slot_id, action FROM v_txn")
def ledger_repeated_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The booking log in three batches: one breaks off after its rows and is repeated, one is
    repeated when it is done. Statements go to a dictionary, rows to files, as no database may run."""
    root = run_dir(spark, "ledger")
    done: dict[tuple, str] = {}

    def execute(statement: str, values: list[object]) -> list[tuple]:
        if statement.startswith("SELECT"):
            return [(done[tuple(values)],)] if tuple(values) in done else []
        if statement.startswith("INSERT"):
            done[tuple(values[:2])] = values[2]
        return []

    def broken(statement: str, values: list[object]) -> list[tuple]:
        if statement.startswith("INSERT"):
            raise ConnectionError("the ledger cannot be reached")
        return execute(statement, values)

    def append(rows: DataFrame, table: str) -> None:
        rows.write.mode("append").parquet(f"{root}/{table}")

    log = view(spark, sf, "v_txn").select("transaction_id", "slot_id", "action")
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    batch = [log.filter(part == n) for n in range(3)]
    with suppress(ConnectionError):
        ledger.append_once(batch[0], broken, append, "stg", 0)
    for n in (0, 1, 1, 2):
        ledger.append_once(batch[n], execute, append, "stg", n)
    names = "target string, batch_id int, attempt string"
    finished = spark.createDataFrame([(*key, attempt) for key, attempt in done.items()], names)
    return ledger.counted(spark.read.parquet(f"{root}/stg"), finished, "stg").select(*log.columns)


# the view that holds the versions of each captured table, and names that differ from the table's
CHANGES = {
    "doctor": ("v_doctor_change", {"start_days": "start_working_date"}),
    "patient": ("v_patient_change", {"birth_days": "date_of_birth"}),
    "slot_code_template": ("v_slot_code_change", {}),
    "doctor_slot": ("v_slot_version", {}),
    "appointment": ("v_appointment_version", {}),
    "appointment_transaction": ("v_txn_version", {}),
    "medical_record": ("v_record_version", {}),
}


def written(name: str) -> list[str]:
    """The tables that follow from a captured one."""
    facts = [staging.SLOT_FACTS[name][0]] if name in staging.SLOT_FACTS else []
    return [TABLES[name].staging_table, *staging.DIMENSIONS.get(name, {}), *facts]


def change_messages(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table's versions as topic messages."""
    cfg = TABLES[name]
    source, renames = CHANGES[name]
    rows = view(spark, sf, source).withColumnsRenamed(renames)
    if "cdc_ts" in rows.columns:
        rows = rows.withColumnsRenamed({"cdc_ts": "ts", "source_offset": "kafka_offset"})
    wire = {"days": F.unix_date, "micros": F.unix_micros}
    plain = {"date", "timestamp"}
    kinds = dict(rows.dtypes)
    columns = [
        (wire[kind](F.col(c)) if kind in wire and kinds.get(c) in plain else F.col(c)).alias(c)
        if c in rows.columns
        else F.lit(None).cast(cfg.row_schema[c].dataType).alias(c)
        for c, kind in cfg.fields
    ]
    return messages(rows.select(*columns, "op", "ts", "kafka_offset"), cfg, cfg.topic())


def streamed_warehouse(spark: SparkSession, sf: str) -> str:
    """All seven tables through their streams, slots in several micro-batches; the folder."""
    root = run_dir(spark, "streams")

    def stream(name: str):
        cfg = TABLES[name]
        batches = 4 if cfg is SLOT else 1
        topic_files(change_messages(spark, sf, name), f"{root}/topics/{name}", batches)
        source = file_stream(spark, cfg.topic(), f"{root}/topics/{name}", batches)
        return staging.table_stream(source, cfg, staging.stage_and_build(cfg, root), f"{root}/checkpoints")

    facts = [name for name in TABLES if name in staging.SLOT_FACTS]
    staging.run_all(
        [stream(name) for name in TABLES if name not in facts],
        once=True,
        after=[stream(name) for name in facts],
    )
    return root


@query(
    "stream_facts",
    FACT_APPOINTMENT + "SELECT * REPLACE (date_trunc('second', booked_at) AS booked_at) FROM fact",
)
def stream_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Bookings staged after all slots, whose versions came in several micro-batches."""
    root = streamed_warehouse(spark, sf)
    return read_batches(spark, f"{root}/fact_appointment")


@query(
    "stream_tables",
    with_views(*[source for source, _ in CHANGES.values()])
    + " UNION ALL ".join(
        f"SELECT '{table}' AS name, count(*) AS n FROM {CHANGES[name][0]}"
        for name in CHANGES
        for table in written(name)
    ),
)
def stream_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every staging table, dimension and fact that the seven streams wrote."""
    root = streamed_warehouse(spark, sf)
    counts = [
        spark.read.parquet(f"{root}/{table}").select(F.lit(table).alias("name"))
        for name in CHANGES
        for table in written(name)
    ]
    rows = counts[0]
    for more in counts[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_late_slots",
    FACT_APPOINTMENT
    + """SELECT appointment_id, arg_max({'v': doctor_id}, o)['v'] AS doctor_id,
  arg_max({'v': slot_code}, o)['v'] AS slot_code FROM (SELECT *, (dw_updated_at, dw_version) AS o FROM fact)
GROUP BY appointment_id HAVING arg_max(is_deleted, o) = 0""",
)
def stream_late_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Bookings staged before any slot; the facts follow when the slots arrive, and the current view of
    the tables is right without looking anything up."""
    root = run_dir(spark, "late-slots")
    for name in ("appointment", "doctor_slot"):
        cfg = TABLES[name]
        topic_files(change_messages(spark, sf, name), f"{root}/topics/{name}", 2)
        source = file_stream(spark, cfg.topic(), f"{root}/topics/{name}", 2)
        stream = staging.table_stream(source, cfg, staging.stage_and_build(cfg, root), f"{root}/checkpoints")
        staging.run_all([stream], once=True)
        follow.follow(spark, root, "fact_appointment")
    facts = read_batches(spark, f"{root}/fact_appointment")
    facts = follow.with_corrections(spark, facts, root, "fact_appointment")
    view = plan.current_views({"fact_appointment": facts})["vw_fact_appointment_current"]
    return view.select("appointment_id", "doctor_id", "slot_code")


@query("stream_first_events", _DEDUP_SQL)
def stream_first_events(spark: SparkSession, sf: str) -> DataFrame:
    """The booking log twice over in three micro-batches, the newest third first, with keys remembered
    for 30 days of event time: what went out, and what came later than that and never had."""
    root = run_dir(spark, "first-events")
    # decoded messages are cut to seconds
    log = view(spark, sf, "v_txn_version").withColumns(
        {
            "is_deleted": F.when(F.col("op") == "d", 1).otherwise(0),
            "created_at": F.date_trunc("second", "created_at"),
        }
    )
    bounds = log.agg(F.percentile_approx("source_offset", [0.33, 0.66])).first()[0]
    offset = F.col("source_offset")
    parts = [offset > bounds[1], (offset > bounds[0]) & (offset <= bounds[1]), offset <= bounds[0]]
    twice = log.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2))))
    events = notify.booking_events(twice, moment(SINCE)).drop("_copy")
    write = first_events.dedupe_writer(f"{root}/out", keep=30)
    for part in parts:
        events.filter(part).coalesce(1).write.mode("append").parquet(f"{root}/log")
        source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/log")
        staging.run_all([first_events.dedupe_stream(source, write, f"{root}/checkpoint")], once=True)
    sent = read_batches(spark, f"{root}/out/sent").unionByName(first_events.settle_late(spark, f"{root}/out"))
    return topics.notifications(writers.as_messages(notify.to_messages(sent), notifications.TOPIC))


def admitted(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """All requests, in order of time, through the booking stream in three micro-batches."""
    root = run_dir(spark, "admission")
    slots, requests = view(spark, sf, "v_slot"), view(spark, sf, "v_request")
    bookings.open_slots(slots, root, first_transaction=1001, first_appointment=5001)
    numbered = number_rows(requests, ["requested_at", "request_id"], "_number")
    n = numbered.count()
    dealt = materialise(numbered.withColumn("_third", F.floor((F.col("_number") - 1) * 3 / F.lit(max(n, 1)))))
    write = bookings.admission_writer(root, slots)
    for k in range(3):
        some = dealt.filter(F.col("_third") == k).drop("_third", "_number")
        some.write.mode("append").parquet(f"{root}/requests")
        source = spark.readStream.schema(requests.schema).parquet(f"{root}/requests")
        staging.run_all([bookings.admission_stream(source, write, f"{root}/checkpoint")], once=True)
    return root, slots


@query("stream_booking_admit", ORACLES["booking_admit"])
def stream_booking_admit(spark: SparkSession, sf: str) -> DataFrame:
    """Verdicts of requests decided batch by batch."""
    root, _ = admitted(spark, sf)
    return read_batches(spark, f"{root}/verdicts")


@query("stream_booking_transactions", ORACLES["booking_admit_transactions"])
def stream_booking_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Log entries of requests decided batch by batch; ids go on from one to the next."""
    root, _ = admitted(spark, sf)
    return read_batches(spark, f"{root}/transactions")


@query("stream_booking_slots", ORACLES["booking_admit_slots"])
def stream_booking_slots(spark: SparkSession, sf: str) -> DataFrame:
    """The slots as they stand after the last batch."""
    root, slots = admitted(spark, sf)
    return bookings.slots_now(spark, root, slots)
