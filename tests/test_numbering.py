"""Row numbers without gaps, also where one key holds most rows."""

import random

from pyspark.sql import functions as F

from slotstream.operators import mutations, records
from slotstream.operators.numbering import number_rows


def test_global_numbers(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("v"))
    out = number_rows(df, ["v"], "n", start=100).collect()
    assert sorted((r.v, r.n) for r in out) == [(v, v + 100) for v in range(5000)]


def test_numbers_per_key_with_a_hot_key(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(40)}", i) for i in range(4000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, v int").repartition(6)
    out = number_rows(df, ["v"], "n", keys=["k"]).collect()
    wanted, seen = {}, {}
    for k, v in sorted(data, key=lambda r: r[1]):
        seen[k] = seen.get(k, 0) + 1
        wanted[v] = seen[k]
    assert {r.v: r.n for r in out} == wanted


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [("a", 1)], "k string, v int")
    out = number_rows(df, ["v"], "n", keys=["k"]).filter("k is null").collect()
    assert sorted(r.n for r in out) == list(range(1, 51))


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert number_rows(df, ["v"], "n").count() == 0
    assert number_rows(df, ["v"], "n", keys=["k"]).count() == 0


def test_sequence_ids_are_never_cut(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    made = mutations.with_sequence_ids(df, ["v"], "id", prefix="DR", width=3, start=999)
    assert rows(made) == [(1, "DR999"), (2, "DR1000")]


def test_append_versions(spark, rows):
    schema = "slot_id string, patient_id int, version_number int, record_id string"
    current = spark.createDataFrame([("S1", 1, 1, "R1"), ("S1", 1, 2, "R2"), ("S2", 1, 0, "R3")], schema)
    new = spark.createDataFrame(
        [("S1", 1, "n2", 20), ("S1", 1, "n1", 10), ("S1", 2, "n3", 5), ("S2", 1, "n4", 1)],
        "slot_id string, patient_id int, note string, at int",
    )
    out = records.append_versions(current, new, ["at"])
    assert rows(out, "note", "version_number") == [("n1", 3), ("n2", 4), ("n3", 1), ("n4", 1)]
    per_slot = records.append_versions(current, new, ["at"], keys=("slot_id",))
    assert rows(per_slot, "note", "version_number") == [("n1", 4), ("n2", 5), ("n3", 3), ("n4", 1)]
