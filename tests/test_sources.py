"""CSV inputs, file topics, option building, JDBC writing, first load."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slotstream.plans import seed
from slotstream.sinks import writers
from slotstream.sources import files, tables, topics
from slotstream.sources.registry import TABLES, WAREHOUSE_TABLES

BOM = "﻿"


def put(tmp_path, name, *lines, bom=True):
    path = tmp_path / name
    path.write_text((BOM if bom else "") + "\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture
def paths(tmp_path):
    return {
        "doctor": put(
            tmp_path, "doctor.csv", "doctorName,specialty,StartWorkingDate", "Zoë Ä,Skin,4/7/2018", "Al,Eyes,12/31/2019"
        ),
        "patient": put(
            tmp_path,
            "patient.csv",
            "patientName,address,phoneNumber,insuranceNumber,dateOfBirth,gender,email",
            "Ann,Road 1,912345678,GD0000000000001,1990-02-03,female,a@b.c",
            'Bo,"Road 2, left",0912345679,GD0000000000002,2/3/1991,male,',
        ),
        "doctor_slot": put(
            tmp_path,
            "slot.csv",
            "slotID,doctorID,date,slotCode",
            "20260504DR0018A,DR001,2026-05-04,8A",
            "20260504DR0018A,DR001,2026-05-04,8A",
            "20260504DR0018B,DR001,5/4/2026,8B",
        ),
        "appointment_transaction": put(
            tmp_path,
            "log.csv",
            "slotID,patientID,status,event_timestamp",
            "20260504DR0018A,0001,booked,2026-05-01 09:20am",
            "20260504DR0018A,1,cancelled,2026-05-01 01:05pm",
            "20260504DR0018B,2,Booked,2026-05-01 12:00am",
        ),
        "medical_record": put(
            tmp_path,
            "record.csv",
            "slotID,patientID,version,diagnosis,treatment,updated_at",
            '20260504DR0018A,1,1,"cough, mild",rest,2026-05-04 10:00',
            "20260504DR0018A,1,1,again,again,2026-05-04 10:00",
            "20260504DR0018A,1,2,better,NaN,2026-05-05 10:00",
        ),
    }


def test_doctors_and_patients(spark, paths, rows):
    assert rows(files.doctor_csv(spark, paths["doctor"])) == [
        ("Al", "Eyes", dt.date(2019, 12, 31)),
        ("Zoë Ä", "Skin", dt.date(2018, 4, 7)),
    ]
    assert rows(files.patient_csv(spark, paths["patient"]), "phone_number", "date_of_birth", "address", "email") == [
        ("0912345678", dt.date(1990, 2, 3), "Road 1", "a@b.c"),
        ("0912345679", dt.date(1991, 2, 3), "Road 2, left", None),
    ]


def test_log(spark, paths, rows):
    assert rows(files.transaction_csv(spark, paths["appointment_transaction"]), "patient_id", "action", "created_at") == [
        (1, "BOOKED", dt.datetime(2026, 5, 1, 9, 20)),
        (1, "CANCELLED", dt.datetime(2026, 5, 1, 13, 5)),
        (2, "BOOKED", dt.datetime(2026, 5, 1, 0, 0)),
    ]


def test_synonyms(spark, tmp_path, rows):
    path = put(tmp_path, "demo.csv", "transaction_id,slotid,status,event_timestamp,patientID",
               "T1,S1,book,2026-05-15 09:00am,008202", "T2,S1,cancel,2026-05-15 09:15am,008202", bom=False)
    assert rows(files.transaction_csv(spark, path), "action") == [("BOOK",), ("CANCEL",)]
    assert rows(files.transaction_csv(spark, path, synonyms=True), "action", "patient_id") == [
        ("BOOKED", 8202), ("CANCELLED", 8202),
    ]


def test_appointments(spark, tmp_path, rows):
    path = put(tmp_path, "a.csv", "booking_ref,slotID,patientID,booked_at", "B1,S1,5,2026-05-15 09:00am", ",S2,nan,")
    assert rows(files.appointment_csv(spark, path)) == [
        ("B1", "S1", 5, dt.datetime(2026, 5, 15, 9, 0)), (None, "S2", None, None),
    ]


def test_missing_column_is_named(spark, tmp_path):
    path = put(tmp_path, "bad.csv", "doctorName,specialty", "x,y")
    with pytest.raises(ValueError, match="StartWorkingDate"):
        files.doctor_csv(spark, path)


def test_first_load(spark, paths, rows):
    out = seed.seed(spark, paths)
    assert rows(out["doctor"], "doctor_id", "doctor_name") == [("DR001", "Zoë Ä"), ("DR002", "Al")]
    assert out["doctor_slot"].count() == 2
    assert rows(out["appointment_transaction"], "transaction_id", "action") == [
        ("TXN2600000001", "BOOKED"), ("TXN2600000002", "CANCELLED"), ("TXN2600000003", "BOOKED"),
    ]
    assert rows(out["appointment"], "appointment_id", "booking_ref", "slot_id") == [
        (1, "TXN2600000003", "20260504DR0018B")
    ]
    assert rows(out["medical_record"], "record_id", "version_number", "prescription_note") == [
        ("REC2600000001", 1, "rest"), ("REC2600000002", 2, None),
    ]
    assert out["doctor_insert_month"].count() == 2 * 296


def test_equal_lines_get_numbers_of_their_own(spark, tmp_path):
    lines = ["slotID,patientID,status,event_timestamp"] + ["S1,1,booked,2026-05-01 09:20am"] * 500
    path = put(tmp_path, "same.csv", *lines)
    log = seed.transactions(files.transaction_csv(spark, path, lines=True))
    assert sorted(r.transaction_id for r in log.collect()) == [f"TXN26{i:08d}" for i in range(1, 501)]


def test_notes_over_several_lines(spark, tmp_path, rows):
    path = put(tmp_path, "r.csv", "slotID,patientID,version,diagnosis,treatment,updated_at",
               'S1,1,1,"first\nsecond ""quoted""",  spaced ,2026-05-04 10:00')
    assert rows(files.record_csv(spark, path), "diagnosis_note", "prescription_note") == [
        ('first\nsecond "quoted"', "  spaced "),
    ]


def test_file_topics(spark, tmp_path, rows):
    data = [(None, "a", "t1", 0, 1), ("k", '{"x":1}', "t2", 0, 1), ("k", "b", "t3", 0, 1)]
    df = spark.createDataFrame(data, "key string, value string, topic string, partition int, offset long")
    df.withColumn("timestamp", F.current_timestamp()).write.parquet(str(tmp_path / "m"))
    both = topics.batch(spark, ["t1", "t2"], fmt="parquet", path=str(tmp_path / "m"))
    assert rows(topics.raw_view(both), "topic", "key", "value") == [("t1", None, "a"), ("t2", "k", '{"x":1}')]
    assert topics.raw_view(both).filter("topic = 't2'").first().document == {"x": "1"}
    stream = topics.stream(spark, "t3", fmt="parquet", path=str(tmp_path / "m"))
    assert stream.isStreaming and stream.columns == both.columns


def test_sources_ask_for_what_they_need(spark):
    with pytest.raises(ValueError, match="servers"):
        topics.stream(spark, "t")
    with pytest.raises(ValueError, match="path"):
        topics.batch(spark, "t", fmt="parquet")
    with pytest.raises(ValueError, match="bounds"):
        tables.jdbc_table(spark, "jdbc:x", "t", partition_column="id")
    with pytest.raises(ValueError, match="single"):
        tables.jdbc_table(spark, "jdbc:x", "t")


def test_files_with_other_columns_are_refused(spark, tmp_path):
    folder = tmp_path / "slots"
    folder.mkdir()
    (folder / "a.csv").write_text("slotID,doctorID,date,slotCode\nS1,DR1,2026-05-04,8A\n")
    (folder / "b.csv").write_text("doctorID,slotID,date,slotCode\nDR2,S2,2026-05-04,8A\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.slot_csv(spark, str(folder)).collect()


def test_large_files_are_split_and_keep_their_order(spark, tmp_path):
    path = tmp_path / "log.csv"
    lines = [f"S{i},{i},booked,01/05/2026 08:00 am" for i in range(40_000)]
    path.write_text("slotID,patientID,status,event_timestamp\n" + "\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        found = files.transaction_csv(spark, str(path), lines=True)
        assert found.rdd.getNumPartitions() > 3
        numbered = seed.transactions(found).select("transaction_id", "patient_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.patient_id for r in sorted(numbered)] == list(range(40_000))


def test_table_reads_push_the_predicate(spark, tmp_path, capsys):
    spark.range(100).selectExpr("id", "id * 2 AS v", "'x' AS w").write.parquet(str(tmp_path / "t"))
    df = tables.table(spark, "t", root=str(tmp_path))
    tables.fetch_all(df, F.col("id") == 5, ["v"]).explain()
    plan = capsys.readouterr().out
    assert "EqualTo(id,5)" in plan and "ReadSchema: struct<id:bigint,v:bigint>" in plan
    assert tables.fetch_one(df, F.col("id") > 5).count() == 1


class Recorder:
    """Stands for the writer of a DataFrame and keeps what it was told."""

    def __init__(self):
        self.told = {}

    @property
    def write(self):
        return self

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **kw):
        self.told.update(kw)
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def save(self):
        self.told["saved"] = True


def test_topic_writer_asks_for_kafka(spark):
    stream = spark.readStream.format("rate").load().selectExpr("CAST(value AS STRING) AS key", "'x' AS value")
    writer = writers.topic_writer(stream, "t", checkpoint="/tmp/never", servers="broker:9092")
    with pytest.raises(Exception, match="[Kk]afka"):
        writer.start()


def test_jdbc_append():
    frame = Recorder()
    writers.jdbc_append(frame, "jdbc:db", "stg_doctor", {"user": "u"}, batchsize=500)
    assert frame.told == {
        "format": "jdbc", "url": "jdbc:db", "dbtable": "stg_doctor", "batchsize": 500, "user": "u",
        "mode": "append", "saved": True,
    }


def test_registry():
    assert list(TABLES) == [
        "doctor", "patient", "slot_code_template", "doctor_slot", "appointment", "appointment_transaction",
        "medical_record",
    ]
    assert len(WAREHOUSE_TABLES) == 22
    assert TABLES["doctor"].topic("x.public") == "x.public.doctor"
    assert all(cfg.columns[0] == cfg.pk for cfg in TABLES.values())
