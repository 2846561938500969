"""Enrichment bounded by the batch: what is read and shuffled of the reference tables."""

import re

import pytest
from pyspark.sql import functions as F

from slotstream.operators import notify
from slotstream.operators.joins import named
from slotstream.streaming import notifications


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def references(spark, tmp_path):
    """20,000 slots in files sorted by id, with patients and doctors."""
    n = spark.range(20_000)
    slots = n.select(
        F.format_string("2026%06d", "id").alias("slot_id"),
        F.lit("2026-01-01").cast("date").alias("slot_date"),
        F.lit("A").alias("slot_code"),
        F.concat(F.lit("D"), F.col("id") % 50).alias("doctor_id"),
    )
    patients = n.select(
        F.col("id").cast("int").alias("patient_id"), F.lit("P").alias("patient_name"), F.lit("p@x").alias("email")
    )
    doctors = n.limit(50).select(
        F.concat(F.lit("D"), "id").alias("doctor_id"), F.lit("N").alias("doctor_name"), F.lit("S").alias("specialty")
    )
    out = []
    for name, df, key in (("p", patients, "patient_id"), ("s", slots, "slot_id"), ("d", doctors, "doctor_id")):
        df.repartitionByRange(8, key).sortWithinPartitions(key).write.parquet(f"{tmp_path}/{name}")
        out.append(spark.read.parquet(f"{tmp_path}/{name}"))
    return out


EVENT = "notification_key string, slot_id string, patient_id long, event_time string"


def test_only_what_the_batch_names_is_shuffled(spark, references):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.createDataFrame(
            [("a", "2026000100", 7, ""), ("b", "2026000103", 9, ""), ("c", "gone", 7, ""), ("d", None, None, "")], EVENT
        ).filter("notification_key <> 'c'")
        patients, slots, doctors = notifications.only_named(events, *references)
        assert (patients.count(), slots.count(), doctors.count()) == (2, 2, 2)
        wanted = notify.enrich(events, *references)
        got = notify.enrich(events, patients, slots, doctors)
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
        text = plan_of(patients)
        # one exchange, of the batch's keys; the table itself is scanned in range and not shuffled
        assert "LeftSemi" in text and "BroadcastExchange" in text
        assert len(re.findall(r"Exchange hashpartitioning", text)) <= 1
        near = plan_of(named(references[1], events, "slot_id"))
        assert "GreaterThanOrEqual(slot_id,2026000100)" in near and "LessThanOrEqual(slot_id,2026000103)" in near
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_many_keys_and_none(spark, references):
    slots = references[1]
    some = slots.limit(10).select("slot_id")
    assert named(slots, some, "slot_id", most=9) is slots
    assert named(slots, some, "slot_id", most=10).count() == 10
    assert named(slots, some.limit(0), "slot_id").count() == 0
    assert named(slots, some.select(F.lit(None).cast("string").alias("slot_id")), "slot_id").count() == 0
