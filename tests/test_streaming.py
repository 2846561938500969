"""Streams: equal to the batch, safe to restart, bounded in state."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from slotstream.operators import cdc, warehouse
from slotstream.plans import warehouse as plan
from slotstream.sinks import writers
from slotstream.sources import topics
from slotstream.sources.registry import TABLES, WAREHOUSE_TABLES
from slotstream.streaming import notifications, outbox, staging

SLOT, APPOINTMENT, LOG = (TABLES[n] for n in ("doctor_slot", "appointment", "appointment_transaction"))
KINDS = {"text": "x", "clock": "08:00", "int": 7, "days": 19000, "micros": 1700000000000000}


def message(cfg, offset, op="c", ts_ms=None, **values):
    row = {**{n: KINDS[k] for n, k in cfg.fields}, **values}
    sides = {"before": row, "after": None} if op == "d" else {"before": None, "after": row}
    value = json.dumps({"payload": {**sides, "op": op, "ts_ms": ts_ms or 1700000000000 + offset * 1000}})
    return (str(row[cfg.pk]), value, cfg.topic(), 0, offset)


def write_messages(spark, path, data):
    schema = "key string, value string, topic string, partition int, offset long"
    df = spark.createDataFrame(data, schema).withColumn("timestamp", F.current_timestamp())
    df.coalesce(1).write.mode("append").parquet(path)


def slot_log(n, seed=1):
    rng = random.Random(seed)
    return [
        message(SLOT, i, rng.choice("cuurd"), slot_id=f"S{rng.randrange(12)}", doctor_id=f"DR{i}",
                slot_date=rng.choice([None, 19000 + i]))
        for i in range(n)
    ]


def start(spark, path, root, write, on_metrics=None, per_batch="1"):
    source = topics.stream(
        spark, SLOT.topic(), fmt="parquet", path=path, options={"maxFilesPerTrigger": per_batch}
    )
    stream = staging.table_stream(source, SLOT, write, f"{root}/checkpoints", on_metrics=on_metrics)
    return staging.run_all([stream], once=True)


def staged(spark, root):
    return spark.read.parquet(f"{root}/stg_doctor_slot").drop("dw_ingested_at", "dw_batch_id")


def test_batches_equal_one_batch_and_restart_adds_nothing(spark, tmp_path, rows):
    path, root = str(tmp_path / "topic"), str(tmp_path / "root")
    data = slot_log(60)
    for i in range(0, 40, 10):
        write_messages(spark, path, data[i : i + 10])
    counts = []
    write = staging.stage_and_build(SLOT, root)
    start(spark, path, root, write, lambda table, batch, c: counts.append((batch, c["total_rows"])))
    assert counts == [(0, 10), (1, 10), (2, 10), (3, 10)]
    start(spark, path, root, write)
    assert staged(spark, root).count() == 40
    for i in range(40, 60, 10):
        write_messages(spark, path, data[i : i + 10])
    start(spark, path, root, write)
    whole = topics.batch(spark, SLOT.topic(), fmt="parquet", path=path)
    batch = plan.stage({"doctor_slot": whole})["stg_doctor_slot"]
    assert rows(staged(spark, root)) == rows(batch.drop("dw_ingested_at", "dw_batch_id"))
    for name in ("dim_doctor_slot", "fact_slot_daily"):
        derive = staging.DIMENSIONS["doctor_slot"][name]
        streamed = spark.read.parquet(f"{root}/{name}").drop("dw_batch_id")
        assert rows(warehouse.current(streamed, name)) == rows(warehouse.current(derive(batch), name))


def test_repeated_batch_replaces_itself(spark, tmp_path, rows):
    root = str(tmp_path / "root")
    raw = spark.createDataFrame(
        slot_log(10), "key string, value string, topic string, partition int, offset long"
    )
    decoded = cdc.decode(raw, SLOT, keep_null_keys=True)
    write = writers.batch_writer(SLOT, staging.stage_and_build(SLOT, root))
    for _ in range(2):
        write(decoded, 7)
    write(decoded.limit(0), 8)
    assert staged(spark, root).count() == 10
    assert spark.read.parquet(f"{root}/fact_slot_daily").count() == 10


def test_metrics_see_null_keys(spark, tmp_path):
    seen = {}
    raw = spark.createDataFrame(
        [message(SLOT, 0), message(SLOT, 1, slot_id=None)],
        "key string, value string, topic string, partition int, offset long",
    )
    write = writers.batch_writer(
        SLOT, staging.stage_only(SLOT, str(tmp_path)), on_metrics=lambda t, b, c: seen.update(c)
    )
    write(cdc.decode(raw, SLOT, keep_null_keys=True), 0)
    assert seen == {"total_rows": 2, "null_key_rows": 1, "clean_rows": 1}
    assert staged(spark, str(tmp_path)).count() == 1


def test_staging_to_a_database(spark, monkeypatch):
    told = []
    monkeypatch.setattr(
        writers, "jdbc_append", lambda df, url, table, props, batchsize: told.append((df, url, table, batchsize))
    )
    raw = spark.createDataFrame([message(SLOT, 0)], "key string, value string, topic string, partition int, offset long")
    write = writers.batch_writer(SLOT, staging.stage_to_jdbc(SLOT, "jdbc:db"))
    write(cdc.decode(raw, SLOT, keep_null_keys=True), 4)
    df, url, table, size = told[0]
    assert (url, table, size) == ("jdbc:db", "stg_doctor_slot", 1000)
    assert df.columns == [*SLOT.columns, "op", "is_deleted", "cdc_ts", "dw_ingested_at", "dw_batch_id"]
    assert df.first().dw_batch_id == 4


def test_rejected_messages_are_kept(spark, tmp_path, rows):
    path, out = str(tmp_path / "topic"), str(tmp_path / "rejected")
    bad = ("k", "not json", SLOT.topic(), 0, 5)
    far = message(SLOT, 2, slot_date=10**12)
    write_messages(spark, path, [message(SLOT, 0), bad, message(SLOT, 1, slot_id=None), far])
    source = topics.stream(spark, SLOT.topic(), fmt="parquet", path=path)
    staging.run_all([staging.rejected_stream(source, SLOT, out, str(tmp_path / "cp"))], once=True)
    assert rows(spark.read.parquet(out), "reason", "source_offset") == [
        ("bad_number", 2), ("null_key", 1), ("unparsable", 5),
    ]
    wide = spark.createDataFrame(
        [message(APPOINTMENT, 0, appointment_id=3_000_000_000), message(APPOINTMENT, 1)],
        "key string, value string, topic string, partition int, offset long",
    )
    assert rows(cdc.decode(wide, APPOINTMENT), "source_offset") == [(1,)]
    assert rows(cdc.rejected(wide, APPOINTMENT), "reason", "source_offset") == [("bad_number", 0)]


def test_facts_follow_their_slot(spark, tmp_path, rows):
    """A booking before its slot gets empty columns; compaction puts them right later."""
    root = str(tmp_path / "root")

    def feed(cfg, batch, *data):
        raw = spark.createDataFrame(list(data), "key string, value string, topic string, partition int, offset long")
        writers.batch_writer(cfg, staging.stage_and_build(cfg, root))(
            cdc.decode(raw, cfg, keep_null_keys=True), batch
        )

    feed(APPOINTMENT, 0, message(APPOINTMENT, 1, appointment_id=1, slot_id="S1"))
    feed(SLOT, 0, message(SLOT, 2, slot_id="S1", doctor_id="DR5"))
    feed(APPOINTMENT, 1, message(APPOINTMENT, 3, appointment_id=2, slot_id="S1"))
    facts = spark.read.parquet(f"{root}/fact_appointment").drop("dw_batch_id")
    assert rows(facts, "appointment_id", "doctor_id") == [(1, ""), (2, "DR5")]
    feed(APPOINTMENT, 2, message(APPOINTMENT, 4, appointment_id=2, slot_id="S1", booking_ref="B2"))
    slots = warehouse.slot_attributes(spark.read.parquet(f"{root}/stg_doctor_slot"))
    views = plan.current_views({"fact_appointment": facts}, slots)
    assert rows(views["vw_fact_appointment_current"], "appointment_id", "doctor_id") == [(1, "DR5"), (2, "DR5")]


def test_compaction_goes_on_while_batches_arrive(spark, tmp_path, rows):
    root, target = str(tmp_path / "root"), str(tmp_path / "compact")
    schema = "key string, value string, topic string, partition int, offset long"

    def feed(batch, *data):
        raw = spark.createDataFrame(list(data), schema)
        writers.batch_writer(SLOT, staging.stage_and_build(SLOT, root))(
            cdc.decode(raw, SLOT, keep_null_keys=True), batch
        )

    def current():
        found = plan.versions(spark, root, target, "dim_doctor_slot")
        every = spark.read.parquet(f"{root}/dim_doctor_slot").drop(writers.BATCH)
        assert rows(warehouse.current(found, "dim_doctor_slot")) == rows(warehouse.current(every, "dim_doctor_slot"))
        return rows(warehouse.current(found, "dim_doctor_slot"), "slot_id", "doctor_id")

    feed(0, message(SLOT, 1, slot_id="S1", doctor_id="DR1"), message(SLOT, 2, slot_id="S2", doctor_id="DR2"))
    assert current() == [("S1", "DR1"), ("S2", "DR2")]
    assert plan.compact_table(spark, root, target, "dim_doctor_slot") == 0
    feed(1, message(SLOT, 3, slot_id="S1", doctor_id="DR3", slot_date=None), message(SLOT, 4, "d", slot_id="S2"))
    assert current() == [("S1", "DR3")]
    assert plan.compact_table(spark, root, target, "dim_doctor_slot") == 1
    assert plan.compact_table(spark, root, target, "dim_doctor_slot") == 1
    feed(2, message(SLOT, 5, slot_id="S3", doctor_id="DR4"))
    assert current() == [("S1", "DR3"), ("S3", "DR4")]


def test_all_seven_streams(spark, tmp_path):
    path, root = str(tmp_path / "topics"), str(tmp_path / "root")
    write_messages(spark, path, [message(cfg, i) for i, cfg in enumerate(TABLES.values())])
    streams = [
        staging.table_stream(
            topics.stream(spark, cfg.topic(), fmt="parquet", path=path), cfg,
            staging.stage_and_build(cfg, root), f"{root}/checkpoints",
        )
        for cfg in sorted(TABLES.values(), key=lambda c: c.name in staging.SLOT_FACTS)
    ]
    staging.run_all(streams, once=True)
    stored = {n: spark.read.parquet(f"{root}/{n}") for n in WAREHOUSE_TABLES if not n.startswith("vw_")}
    assert {n: df.count() for n, df in stored.items()} == {n: 1 for n in stored}
    plan.compact_all(spark, root, f"{root}-compact")
    assert plan.versions(spark, root, f"{root}-compact", "fact_medical_record").count() == 1
    with pytest.raises(ValueError):
        plan.compact_all(spark, root, root + "/")
    raw = {
        name: topics.batch(spark, cfg.topic(), fmt="parquet", path=path) for name, cfg in TABLES.items()
    }
    built = plan.build(plan.stage(raw))
    views = plan.current_views(built)
    assert set(built) | set(views) >= {n for n in WAREHOUSE_TABLES if not n.startswith("stg_")}
    plan.register(spark, {**views})
    assert spark.table("vw_dim_doctor_current").count() == 1
    assert all(df.count() == 1 for df in views.values())


def log_files(spark, path, *batches):
    for batch in batches:
        write_messages(spark, path, batch)


def run_events(spark, tmp_path, path, **options):
    source = topics.stream(spark, LOG.topic(), fmt="parquet", path=path, options={"maxFilesPerTrigger": "1"})
    events = notifications.event_stream(source, F.lit(dt.datetime(2020, 1, 1)), **options)
    out = str(tmp_path / "out")
    writer = writers.topic_writer(
        events, notifications.TOPIC, checkpoint=str(tmp_path / "cp"), fmt="parquet", path=out
    )
    queries = staging.run_all([writer], once=True)
    keys = topics.notifications(topics.batch(spark, notifications.TOPIC, fmt="parquet", path=out))
    return sorted(r.notification_key for r in keys.collect()), queries[0]


def booked(offset, key, minute):
    return message(LOG, offset, transaction_id=key, action="BOOKED", ts_ms=1700000000000 + minute * 60000)


HOURS = [
    [booked(0, "A", 0), booked(1, "A", 1)],
    [booked(2, "A", 2), booked(3, "B", 120)],
    [booked(4, "C", 240)],
    [booked(5, "D", 360), booked(6, "LATE", 10)],
]


@pytest.mark.parametrize("salts", [1, 8])
def test_bounded_dedup_drops_copies_late_rows_and_state(spark, tmp_path, salts):
    path = str(tmp_path / "topic")
    log_files(spark, path, *HOURS)
    keys, query = run_events(spark, tmp_path, path, within_watermark=True, salts=salts)
    assert keys == ["A", "B", "C", "D"]
    steps = [op for p in query.recentProgress for op in p["stateOperators"]]
    assert sum(op["numRowsDroppedByWatermark"] for op in steps) >= 1
    assert max(op["numRowsTotal"] for op in query.recentProgress[-1]["stateOperators"]) <= 2


@pytest.mark.parametrize("salts", [1, 8])
def test_dedup_delivers_late_keys_by_default(spark, tmp_path, salts):
    path = str(tmp_path / "topic")
    log_files(spark, path, *HOURS)
    keys, query = run_events(spark, tmp_path, path, salts=salts)
    assert keys == ["A", "B", "C", "D", "LATE"]
    assert max(op["numRowsTotal"] for op in query.recentProgress[-1]["stateOperators"]) >= 5


def test_start_time_is_required(monkeypatch):
    monkeypatch.delenv(notifications.START_VARIABLE, raising=False)
    with pytest.raises(RuntimeError, match="SYSTEM_START_TIME is not set"):
        notifications.start_time()


def test_outbox_stream(spark, tmp_path, rows):
    patients = spark.createDataFrame(
        [(1, "Ann", "a@b.c"), (2, "Bo", None)], "patient_id int, patient_name string, email string"
    )
    slots = spark.createDataFrame(
        [("S1", dt.date(2026, 5, 4), "8A", "DR1")], "slot_id string, slot_date date, slot_code string, doctor_id string"
    )
    doctors = spark.createDataFrame([("DR1", "D", "Skin")], "doctor_id string, doctor_name string, specialty string")

    def event(key, patient):
        return (key, key, "S1", patient, "BOOKED", "BOOKING_CONFIRMATION", "2026-05-01T00:00:00.000Z", "EMAIL")

    def frame(*events):
        return spark.createDataFrame(list(events), notifications.NOTIFICATION_SCHEMA)

    sent = []

    def send(mails):
        sent.extend(r.notification_key for r in mails.collect())
        return mails.filter("notification_key = 'T3'").select("notification_key", F.lit("refused").alias("error_message"))

    root = str(tmp_path / "outbox")
    write = notifications.outbox_writer(
        root, lambda s: (patients, slots, doctors), send=send, now=F.lit(dt.datetime(2026, 5, 2))
    )
    write(frame(event("T1", 1), event("T1", 1), event("T2", 2)), 0)
    write(frame(event("T1", 1), event("T3", 1)), 1)
    write(frame(event("T1", 1), event("T3", 1)), 1)  # the batch is repeated
    write(frame(event("T3", 1), event("T1", 1)), 2)  # only what failed is tried again
    assert sorted(sent) == ["T1", "T3", "T3", "T3"]
    audit = spark.read.parquet(f"{root}/audit")
    assert rows(audit, "dw_batch_id", "notification_key", "send_status", "error_message") == [
        (0, "T1", "SENT", ""),
        (0, "T2", "FAILED", "Patient email is null"),
        (1, "T3", "FAILED", "refused"),
        (2, "T3", "FAILED", "refused"),
    ]
    assert rows(spark.read.parquet(f"{root}/audit_pending"), "dw_batch_id", "notification_key") == [
        (0, "T1"), (1, "T3"), (2, "T3"),
    ]


SENT = []


def keep_mails(mails):
    """A send hook."""
    SENT.extend(r.notification_key for r in mails.collect())


def test_consumer_job(spark, tmp_path, rows):
    tables, path, root = (str(tmp_path / n) for n in ("tables", "topic", "root"))
    spark.createDataFrame([(1, "Ann", "a@b.c")], "patient_id int, patient_name string, email string").write.parquet(
        f"{tables}/patient"
    )
    spark.createDataFrame(
        [("S1", dt.date(2026, 5, 4), "8A", "DR1")], "slot_id string, slot_date date, slot_code string, doctor_id string"
    ).write.parquet(f"{tables}/doctor_slot")
    spark.createDataFrame([("DR1", "D", "Skin")], "doctor_id string, doctor_name string, specialty string").write.parquet(
        f"{tables}/doctor"
    )
    send = outbox.hook(f"{__name__}:keep_mails")
    fields = [f.name for f in notifications.NOTIFICATION_SCHEMA]
    for batch, key in enumerate(["T1", "T1", "T2"]):
        row = [key, key, "S1", 1, "BOOKED", "BOOKING_CONFIRMATION", "2026-05-01T00:00:00.000Z", "EMAIL"]
        value = json.dumps(dict(zip(fields, row, strict=True)))
        write_messages(spark, path, [(key, value, notifications.TOPIC, 0, batch)])
        source = topics.stream(spark, notifications.TOPIC, fmt="parquet", path=path)
        stream = outbox.consumer(
            spark, source, tables=tables, root=root, send=send, checkpoint=str(tmp_path / "cp")
        )
        staging.run_all([stream], once=True)
    audit = spark.read.parquet(f"{root}/audit")
    assert rows(audit, "notification_key", "send_status") == [("T1", "SENT"), ("T2", "SENT")]
    import sys

    assert sys.modules[send.__module__].SENT == ["T1", "T2"]


def test_fact_streams_start_when_slots_have_ended(spark, tmp_path, rows):
    """Slots in several micro-batches, bookings in one: with `once` no fact lacks its slot."""
    root = str(tmp_path / "root")
    for i in range(3):
        write_messages(spark, str(tmp_path / "slots"), [message(SLOT, i, slot_id=f"S{i}", doctor_id=f"DR{i}")])
    bookings = [message(APPOINTMENT, i, appointment_id=i, slot_id=f"S{i}") for i in range(3)]
    write_messages(spark, str(tmp_path / "bookings"), bookings)

    def stream(cfg, folder):
        source = topics.stream(
            spark, cfg.topic(), fmt="parquet", path=str(tmp_path / folder), options={"maxFilesPerTrigger": "1"}
        )
        return staging.table_stream(source, cfg, staging.stage_and_build(cfg, root), f"{root}/checkpoints")

    staging.run_all([stream(SLOT, "slots")], once=True, after=[stream(APPOINTMENT, "bookings")])
    facts = spark.read.parquet(f"{root}/fact_appointment")
    assert rows(facts, "appointment_id", "doctor_id") == [(0, "DR0"), (1, "DR1"), (2, "DR2")]


def test_lookups_read_no_more_files_as_batches_add_up(spark, tmp_path, rows):
    """Slots in twelve micro-batches, folded every three: what a fact batch reads stays bounded."""
    root, schema = str(tmp_path / "root"), "key string, value string, topic string, partition int, offset long"

    def feed(cfg, batch, *data):
        raw = spark.createDataFrame(list(data), schema).coalesce(1)
        writers.batch_writer(cfg, staging.stage_and_build(cfg, root, fold_every=3))(
            cdc.decode(raw, cfg, keep_null_keys=True), batch
        )

    read = []
    for i in range(12):
        gone = [message(SLOT, 100 + i, "d", slot_id=f"S{i - 1}")] if i else []
        feed(SLOT, i, message(SLOT, i, slot_id=f"S{i}", doctor_id=f"DR{i}"), *gone)
        read.append(len(writers.recent(spark, staging.SLOT_VERSIONS, f"{root}/stg_doctor_slot").inputFiles()))
    assert max(read[6:]) <= max(read[:6]) and max(read) <= 3 + 3
    feed(SLOT, 11, message(SLOT, 11, slot_id="S11", doctor_id="DR11"))  # the last batch is repeated
    feed(APPOINTMENT, 0, *[message(APPOINTMENT, i, appointment_id=i, slot_id=f"S{i}") for i in range(12)])
    facts = spark.read.parquet(f"{root}/fact_appointment")
    assert rows(facts, "appointment_id", "doctor_id") == [(i, f"DR{i}") for i in sorted(range(12), key=str)]


def test_sent_keys_are_folded(spark, tmp_path):
    root = str(tmp_path / "outbox")
    patients = spark.createDataFrame([(1, "Ann", "a@b.c")], "patient_id int, patient_name string, email string")
    slots = spark.createDataFrame(
        [("S1", dt.date(2026, 5, 4), "8A", "DR1")], "slot_id string, slot_date date, slot_code string, doctor_id string"
    )
    doctors = spark.createDataFrame([("DR1", "D", "Skin")], "doctor_id string, doctor_name string, specialty string")
    sent = []
    write = notifications.outbox_writer(
        root, lambda s: (patients, slots, doctors), fold_every=2,
        send=lambda mails: sent.extend(r.notification_key for r in mails.collect()),
    )
    for batch in range(7):
        keys = [f"T{batch}", "T0", f"T{max(0, batch - 4)}"]
        events = [(k, k, "S1", 1, "BOOKED", "BOOKING_CONFIRMATION", "2026-05-01T00:00:00.000Z", "EMAIL") for k in set(keys)]
        write(spark.createDataFrame(events, notifications.NOTIFICATION_SCHEMA).coalesce(1), batch)
    assert sorted(sent) == [f"T{i}" for i in range(7)]
    files = writers.recent(spark, notifications.SENT_SCHEMA, f"{root}/audit").inputFiles()
    assert writers.last_state(spark, f"{root}/audit_state") == 5 and len(files) <= 4
