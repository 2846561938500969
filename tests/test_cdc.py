"""Change messages: every odd input the decoder must survive."""

import datetime as dt
import json

from pyspark.sql import functions as F

from slotstream.functions import wire
from slotstream.operators import cdc, quality, staging
from slotstream.sources.registry import TABLES

SLOT = TABLES["doctor_slot"]
ROW = {"slot_id": "S1", "doctor_id": "DR1", "slot_date": 19000, "slot_code": "8A", "slot_status": "AVAILABLE"}


def change(op="c", after=None, before=None, ts_ms=1700000000999):
    return json.dumps({"payload": {"before": before, "after": after, "op": op, "ts_ms": ts_ms}})


def raw(spark, *values):
    return spark.createDataFrame(
        [(v, i) for i, v in enumerate(values)], "value string, offset long"
    )


def test_edges_are_dropped_and_reported(spark, rows):
    wrong = json.dumps({"payload": {"after": {"slot_id": "S2", "slot_date": "soon"}, "op": "c"}})
    messages = raw(
        spark,
        change(after=ROW),
        None,
        "not json",
        "{}",
        '{"payload":null}',
        "null",
        "",
        change(after={**ROW, "slot_id": None}),
        wrong,
    )
    good = cdc.decode(messages, SLOT)
    assert rows(good, "source_offset", "slot_id", "slot_date") == [
        (0, "S1", dt.date(2022, 1, 8)),
        (8, "S2", None),
    ]
    assert dict(rows(cdc.rejected(messages, SLOT), "source_offset", "reason")) == {
        1: "no_value",
        2: "unparsable",
        3: "no_payload",
        4: "no_payload",
        5: "unparsable",
        6: "no_payload",
        7: "null_key",
    }


def test_every_message_is_decoded_or_rejected(spark):
    messages = raw(spark, change(after=ROW), None, "x", "{}", change(after={**ROW, "slot_id": None}))
    assert cdc.decode(messages, SLOT).count() + cdc.rejected(messages, SLOT).count() == messages.count()


def test_value_may_be_bytes(spark, rows):
    messages = raw(spark, change(after=ROW)).withColumn("value", F.col("value").cast("binary"))
    assert rows(cdc.decode(messages, SLOT), "slot_id") == [("S1",)]


def test_seconds_by_default_and_millis_on_request(spark):
    messages = raw(spark, change(after=ROW))
    assert cdc.decode(messages, SLOT).first().cdc_ts == dt.datetime(2023, 11, 14, 22, 13, 20)
    exact = cdc.decode(messages, SLOT, precision="full").first().cdc_ts
    assert exact == dt.datetime(2023, 11, 14, 22, 13, 20, 999000)


def test_negative_and_impossible_numbers(spark):
    one = spark.range(1).select(
        wire.millis_to_ts(F.lit(-1500)).alias("before_epoch"),
        wire.millis_to_ts(F.lit(9223372036854775807)).alias("too_late"),
        wire.micros_to_ts(F.lit(253402300799999999)).alias("last"),
        wire.days_to_date(F.lit(-1)).alias("day"),
        wire.days_to_date(F.lit(99999999999)).alias("no_day"),
    ).first()
    assert one.before_epoch == dt.datetime(1969, 12, 31, 23, 59, 59)
    assert one.too_late is None and one.no_day is None
    assert one.last == dt.datetime(9999, 12, 31, 23, 59, 59)
    assert one.day == dt.date(1969, 12, 31)


def test_delete_with_the_key_only(spark, rows):
    messages = raw(spark, change("d", before={"slot_id": "S1"}))
    out = cdc.decode(messages, SLOT)
    assert rows(out, "slot_id", "doctor_id", "op", "is_deleted") == [("S1", None, "d", 1)]


def test_null_op_is_not_a_delete(spark, rows):
    assert rows(cdc.decode(raw(spark, change(None, after=ROW)), SLOT), "op", "is_deleted") == [(None, 0)]


def test_update_to_null(spark, rows):
    messages = raw(spark, change("u", after={**ROW, "slot_date": None}, before=ROW))
    assert rows(cdc.decode(messages, SLOT), "slot_date") == [(dt.date(2022, 1, 8),)]
    assert rows(cdc.decode(messages, SLOT, image="row"), "slot_date") == [(None,)]


def test_time_of_day(spark, rows):
    clocks = spark.createDataFrame(
        [("28800000000",), ("61200000000",), ("08:30",), (None,), ("99999999999999",)], "t string"
    )
    assert rows(cdc.decode_time_of_day(clocks, ["t"])) == [
        ("08:00",),
        ("08:30",),
        ("17:00",),
        ("99999999999999",),
        (None,),
    ]


def test_metrics_count_before_filtering(spark):
    messages = raw(spark, change(after=ROW), change(after={**ROW, "slot_id": None}))
    counts = quality.batch_metrics(cdc.decode(messages, SLOT, keep_null_keys=True), "slot_id").first()
    assert tuple(counts) == (2, 1, 1)


def test_every_table_survives_the_round_trip(spark):
    kinds = {"text": "x", "clock": "08:00", "int": 7, "days": 19000, "micros": 1700000000000000}
    for cfg in TABLES.values():
        row = {name: kinds[kind] for name, kind in cfg.fields}
        out = staging.to_staging(cdc.decode(raw(spark, change(after=row)), cfg), cfg, batch_id=3)
        assert out.columns[: len(cfg.columns)] == cfg.columns
        got = out.first()
        assert got.dw_batch_id == 3 and got.is_deleted == 0
        assert all(got[name] is not None for name in cfg.columns)


def test_message_is_parsed_once(spark, capsys):
    cdc.decode(raw(spark, change(after=ROW)), SLOT).explain()
    assert capsys.readouterr().out.count("from_json") == 1
