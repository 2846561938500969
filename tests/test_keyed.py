"""The compacted state: finished batches only, untouched parts stay, old files go."""

import pytest

from slotstream.operators import warehouse
from slotstream.plans import warehouse as plan
from slotstream.session import exists, names_in
from slotstream.sinks import keyed, writers

TABLE = "dim_doctor_slot"
SCHEMA = (
    "slot_id string, doctor_id string, slot_date date, slot_code string, slot_status string, is_deleted int, "
    "dw_updated_at timestamp, dw_version long"
)


@pytest.fixture
def feed(spark, tmp_path, ts):
    def write(batch, *slots, done=True):
        """`slots` are (slot, doctor, version); a deleted slot has no doctor."""
        data = [
            (s, d, None, "8A", "AVAILABLE", int(d is None), ts(f"2026-01-01 00:00:{v:02}"), v) for s, d, v in slots
        ]
        folder = writers.parquet_batch(spark.createDataFrame(data, SCHEMA), f"{tmp_path}/root/{TABLE}", batch)
        if not done:
            (tmp_path / f"root/{TABLE}" / folder.rsplit("/", 1)[1] / "_SUCCESS").unlink()

    return write


def state(spark, tmp_path):
    found = plan.versions(spark, f"{tmp_path}/root", f"{tmp_path}/state", TABLE)
    return sorted((r.slot_id, r.doctor_id) for r in warehouse.current(found, TABLE).collect())


def compact(spark, tmp_path, **kind):
    return plan.compact_table(spark, f"{tmp_path}/root", f"{tmp_path}/state", TABLE, **kind)


def files(tmp_path):
    return {p.relative_to(tmp_path) for p in (tmp_path / f"state/{TABLE}/parts").rglob("*.parquet")}


def test_a_batch_being_written_is_left_for_the_next_time(spark, tmp_path, feed):
    feed(0, ("S1", "A", 1), ("S2", "A", 2))
    feed(1, ("S3", "B", 3), done=False)
    feed(2, ("S1", "C", 4))
    assert state(spark, tmp_path) == [("S1", "A"), ("S2", "A")]
    assert compact(spark, tmp_path) == 0 and state(spark, tmp_path) == [("S1", "A"), ("S2", "A")]
    assert compact(spark, tmp_path) == 0
    feed(1, ("S3", "B", 3), ("S4", "B", 3))
    assert state(spark, tmp_path) == [("S1", "C"), ("S2", "A"), ("S3", "B"), ("S4", "B")]
    assert compact(spark, tmp_path) == 2
    assert state(spark, tmp_path) == [("S1", "C"), ("S2", "A"), ("S3", "B"), ("S4", "B")]


def test_only_touched_parts_are_rewritten(spark, tmp_path, feed):
    slots = [(f"S{i}", "A", 1) for i in range(200)]
    feed(0, *slots)
    compact(spark, tmp_path, parts=16)
    first = files(tmp_path)
    assert len({p.parent for p in first}) == 16
    feed(1, ("S7", "B", 2), ("S8", None, 2))
    compact(spark, tmp_path)
    after = files(tmp_path)
    folder = f"{tmp_path}/state/{TABLE}"
    written, parts = keyed.manifest(spark, folder, 1)
    changed = {p for p, n in written.items() if n == 1}
    assert parts == 16 and len(written) == 16 and 1 <= len(changed) <= 2
    assert first < after and {p.parent.name for p in after - first} == {f"{keyed.PART}={p}" for p in changed}
    wanted = sorted([(s, "A") for s, _, _ in slots if s not in ("S7", "S8")] + [("S7", "B")])
    assert state(spark, tmp_path) == wanted
    schema = spark.createDataFrame([], SCHEMA).schema
    some = keyed.read(spark, folder, schema, parts=sorted(changed))
    assert {r.slot_id for r in some.collect()} >= {"S7", "S8"} and some.count() < 100


def test_a_fold_that_did_not_finish_does_not_count(spark, tmp_path, feed):
    feed(0, ("S1", "A", 1))
    compact(spark, tmp_path)
    feed(1, ("S1", "B", 2))
    compact(spark, tmp_path)
    (tmp_path / f"state/{TABLE}/manifest/upto=1/_SUCCESS").unlink()
    assert plan.compacted_upto(spark, f"{tmp_path}/state", TABLE) == 0
    assert state(spark, tmp_path) == [("S1", "B")]
    assert compact(spark, tmp_path) == 1 and state(spark, tmp_path) == [("S1", "B")]


def test_old_batches_and_files_go(spark, tmp_path, feed):
    for batch in range(5):
        feed(batch, ("S1", f"D{batch}", batch), (f"T{batch}", "A", batch))
        assert compact(spark, tmp_path, parts=4, drop=True) == batch
        assert state(spark, tmp_path) == sorted([("S1", f"D{batch}"), *[(f"T{i}", "A") for i in range(batch + 1)]])
    assert names_in(spark, f"{tmp_path}/root/{TABLE}") == [f"{writers.BATCH}=4"]
    folder = f"{tmp_path}/state/{TABLE}"
    assert len(names_in(spark, f"{folder}/manifest")) == 2
    written, _ = keyed.manifest(spark, folder, 4)
    assert all(exists(spark, keyed.part_folder(folder, n, p)) for p, n in written.items())
    assert len({p.parent for p in files(tmp_path)}) <= 8
    assert compact(spark, tmp_path, drop=True) == 4
    feed(4, ("S1", "D4", 4), ("T4", "A", 4))
    assert compact(spark, tmp_path) == 4 and len(state(spark, tmp_path)) == 6


def test_nothing_there(spark, tmp_path):
    assert compact(spark, tmp_path, drop=True) is None
    with pytest.raises(ValueError, match="no finished batch"):
        state(spark, tmp_path)


def test_old_stream_states_go(spark, tmp_path):
    """A fold every batch: the newest states stay and hold what all batches held."""
    path = f"{tmp_path}/table"
    schema = spark.createDataFrame([], "k long, n long").schema
    for batch in range(6):
        writers.fold(spark, schema, path, lambda df: df.distinct(), batch, sort_by=["k"], every=1)
        writers.parquet_batch(spark.createDataFrame([(batch, 1), (0, 1)], schema), path, batch)
    left = sorted(names_in(spark, writers.state_folder(path)))
    assert left == [f"{writers.UPTO}{n}" for n in (2, 3, 4)]
    found = writers.recent(spark, schema, path)
    assert {r.k for r in found.collect()} == set(range(6))
