"""Latest row per key against latest value per column."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from slotstream.operators import latest, warehouse
from slotstream.operators.joins import lookup
from slotstream.plans import warehouse as plan

SCHEMA = "k string, a string, d int, is_deleted int, dw_updated_at int, dw_version int"


def state(df):
    out = latest.current(df, ["k"], ["dw_updated_at", "dw_version"], nullable=("d",))
    return sorted(tuple(r) for r in out.collect())


def test_nullable_columns_keep_the_last_known_value(spark):
    df = spark.createDataFrame([("x", "old", 5, 0, 1, 1), ("x", None, None, 0, 2, 2)], SCHEMA)
    assert state(df) == [("x", None, 5, 0, 2)]
    row = latest.replace_latest(df, ["k"], ["dw_updated_at", "dw_version"]).first()
    assert (row.a, row.d) == (None, None)


def test_deleted_after_reduction(spark):
    df = spark.createDataFrame([("x", "a", 1, 0, 1, 1), ("x", "a", 1, 1, 2, 2)], SCHEMA)
    assert state(df) == []
    again = df.union(spark.createDataFrame([("x", "b", None, 0, 3, 3)], SCHEMA))
    assert state(again) == [("x", "b", 1, 0, 3)]


def test_version_breaks_ties_of_one_second(spark):
    df = spark.createDataFrame([("x", "first", 1, 0, 9, 1), ("x", "second", 2, 0, 9, 2)], SCHEMA)
    assert state(df) == [("x", "second", 2, 0, 9)]


def test_order_and_replay_do_not_matter(spark):
    rng = random.Random(3)
    log = [
        (f"k{rng.randrange(9)}", f"a{i}", rng.choice([None, i]), int(rng.random() < 0.3), i // 4, i)
        for i in range(120)
    ]
    wanted = state(spark.createDataFrame(log, SCHEMA))
    for _ in range(3):
        shuffled = log + rng.sample(log, 40)
        rng.shuffle(shuffled)
        assert state(spark.createDataFrame(shuffled, SCHEMA).repartition(5)) == wanted


def test_against_a_fold(spark):
    rng = random.Random(5)
    log = [(f"k{rng.randrange(6)}", f"a{i}", rng.choice([None, i]), int(rng.random() < 0.3), i, i) for i in range(90)]
    fold = {}
    for k, a, d, gone, at, _ in log:
        kept = fold.get(k, (None, None, 0, 0))
        fold[k] = (a, d if d is not None else kept[1], gone, at)
    wanted = sorted((k, a, d, gone, at) for k, (a, d, gone, at) in fold.items() if not gone)
    assert state(spark.createDataFrame(log, SCHEMA)) == wanted


def test_composite_key(spark, rows):
    df = spark.createDataFrame([("x", 1, 1), ("x", 1, 2), ("x", 2, 1)], "k string, s int, v int")
    assert rows(latest.replace_latest(df, ["k", "s"], ["v"])) == [("x", 1, 2), ("x", 2, 1)]


def versions(spark, *data):
    return spark.createDataFrame(
        [(s, d, c, "AVAILABLE", g, t, 0, t) for s, d, c, g, t in data],
        "slot_id string, doctor_id string, slot_code string, slot_status string, is_deleted int, "
        "cdc_ts int, source_partition int, source_offset long",
    ).withColumn("slot_date", F.date_add(F.lit("2026-01-01").cast("date"), F.col("cdc_ts")))


def bookings(spark):
    return spark.createDataFrame(
        [(1, "B1", "S1", 5, 10, 0), (2, "B2", "S9", 5, 10, 0)],
        "appointment_id int, booking_ref string, slot_id string, patient_id int, cdc_ts int, is_deleted int",
    ).withColumns({"booked_at": F.lit(None).cast("timestamp"), "source_offset": F.lit(1).cast("long")})


def test_fact_meets_the_latest_known_slot(spark, rows):
    slots = warehouse.slot_attributes(
        versions(spark, ("S1", "DR1", "8A", 0, 1), ("S1", "DR2", "8B", 0, 2), ("S1", None, None, 1, 3))
    )
    fact = warehouse.fact_appointment(bookings(spark), slots)
    assert rows(fact, "appointment_id", "doctor_id", "slot_code") == [(1, "DR2", "8B"), (2, "", "")]
    plain = warehouse.fact_appointment(bookings(spark), slots, missing=None)
    assert rows(plain, "appointment_id", "doctor_id") == [(1, "DR2"), (2, None)]


def test_compaction_repairs_late_slots(spark, rows):
    known = warehouse.slot_attributes(versions(spark, ("S9", "DR7", "9A", 0, 1)))
    early = warehouse.fact_appointment(bookings(spark), known)
    later = warehouse.slot_attributes(
        versions(spark, ("S9", "DR7", "9A", 0, 1), ("S1", "DR1", "8A", 0, 4))
    )
    kept = plan.compact("fact_appointment", early.union(early))
    assert kept.count() == 2
    fixed = plan.current_views({"fact_appointment": kept}, later)["vw_fact_appointment_current"]
    assert rows(fixed, "appointment_id", "doctor_id") == [(1, "DR1"), (2, "DR7")]


def test_compaction_keeps_the_current_state(spark):
    """NULLs, deletes, ties and versions that come later though they are older."""
    rng = random.Random(3)
    data = [
        (rng.randrange(6), rng.choice(["a", "b"]), rng.choice([None, None, 1, 2]), rng.choice([None, "x", "y"]),
         int(rng.random() < 0.2), dt.datetime(2026, 1, 1, 0, rng.randrange(12)), n)
        for n in range(150)
    ]
    schema = "k int, v string, n int, m string, is_deleted int, dw_updated_at timestamp, dw_version int"
    order, loose = ["dw_updated_at", "dw_version"], ("n", "m")

    def state(df):
        return sorted(map(tuple, latest.current(df, ["k"], order, nullable=loose).collect()))

    def kept(df):
        return latest.needed_versions(df, ["k"], order, nullable=loose)

    whole = spark.createDataFrame(data, schema)
    early, late = spark.createDataFrame(data[::2], schema), spark.createDataFrame(data[1::2], schema)
    assert state(kept(whole)) == state(whole)
    assert state(kept(early).union(late)) == state(whole)
    assert state(kept(kept(early).union(late))) == state(whole)
    assert kept(whole).groupBy("k").count().agg(F.max("count")).first()[0] <= 3


def test_lookup_refuses_keys_of_other_types(spark):
    one = spark.range(1).select(F.col("id").cast("decimal(10,2)").alias("k"))
    with pytest.raises(TypeError, match="key k"):
        lookup(spark.range(1).withColumnRenamed("id", "k"), one, ["k"])


def test_lookup_matches_a_plain_join(spark, rows):
    many = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    one = spark.createDataFrame([(1, "x"), (3, "z"), (None, "n")], "k int, w string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        assert rows(lookup(many, one, ["k"], how)) == rows(many.join(one, "k", how))


@pytest.mark.parametrize("split", [True, False])
def test_hot_key_is_split_only_with_lookup(spark, tmp_path, split):
    """A third of the left rows share one key: the join must not run them in one task."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
        left = spark.range(0, 120000, numPartitions=8).select(
            key.alias("slot_id"), F.sha2(F.col("id").cast("string"), 512).alias("payload")
        )
        left.write.parquet(str(tmp_path / "left"))
        left = spark.read.parquet(str(tmp_path / "left"))
        right = spark.range(5000).select((F.col("id") % 997).alias("slot_id"), F.col("id").alias("v"))
        slots = latest.replace_latest(right, ["slot_id"], ["v"])
        joined = lookup(left, slots, ["slot_id"]) if split else left.join(slots, "slot_id", "left")
        joined.write.format("noop").mode("overwrite").save()
        total = joined.agg(F.count("payload"), F.count("v"))
        assert [tuple(r) for r in total.collect()] == [(120000, 120000)]
        text = total._jdf.queryExecution().executedPlan().toString()
        assert ("skew=true" in text) == split
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
