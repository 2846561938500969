import json

from slotstream.sources import topics
from slotstream.sources.registry import TABLES
from slotstream.streaming import progress, staging

SLOT = TABLES["doctor_slot"]
TOPIC = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


def files(spark, path, values):
    for n, some in enumerate(values):
        data = [("k", v, SLOT.topic(), 0, n * 100 + i, None) for i, v in enumerate(some)]
        spark.createDataFrame(data, TOPIC).coalesce(1).write.mode("append").parquet(path)


def rejects(spark, tmp_path):
    source = topics.stream(
        spark, SLOT.topic(), fmt="parquet", path=str(tmp_path / "topic"), options={"maxFilesPerTrigger": "1"}
    )
    return staging.rejected_stream(source, SLOT, str(tmp_path / "out"), str(tmp_path / "cp"))


def test_a_row_per_batch(spark, tmp_path):
    files(spark, str(tmp_path / "topic"), [["junk"] * 3, ["junk"] * 5])
    with progress.BatchLog(spark, str(tmp_path / "log")) as log:
        staging.run_all([rejects(spark, tmp_path)], once=True)
    table = progress.batches(spark, str(tmp_path / "log")).filter("input_rows > 0")
    assert sorted((r.input_rows, r.rejected_rows) for r in table.collect()) == [(3, 3), (5, 5)]
    assert log.stopped == []
    rate = progress.rates(table, "year").collect()
    assert sum(r.rejected_rows for r in rate) == 8 and all(r.reject_share == 1 for r in rate)


def test_too_many_rejects_stop_the_streams(spark, tmp_path):
    files(spark, str(tmp_path / "topic"), [["junk"] * 20])
    log = progress.BatchLog(
        spark, str(tmp_path / "log"), limit=0.5, least=10, beside=staging.streams_beside
    )
    with log:
        query = rejects(spark, tmp_path).start()
        assert query.awaitTermination(60)
    assert log.stopped == ["rejected_doctor_slot", SLOT.staging_table]


def test_limits_look_at_the_last_batches(spark, tmp_path):
    log = progress.BatchLog(spark, str(tmp_path / "log"), limit=0.1, window=2, least=100)
    row = lambda total, lost: ("s", "r", 0, None, total, lost, 0, 0, 1)
    for total, lost in [(50, 50), (950, 0), (1000, 150), (1000, 50)]:
        log._judge(row(total, lost))
    assert log.stopped == []
    log._judge(row(1000, 151))
    assert log.stopped == ["s"]


def test_a_batch_that_ran_again_counts_once(spark, tmp_path):
    told = {
        "name": "s", "runId": "a", "batchId": 3, "timestamp": "2026-01-01T00:00:00.000Z", "batchDuration": 5,
        "sources": [{"numInputRows": 4}, {"numInputRows": 2}],
        "stateOperators": [{"numRowsTotal": 7, "memoryUsedBytes": 70}],
    }
    again = json.loads(json.dumps(told | {"runId": "b", "timestamp": "2026-01-01T00:01:00.000Z"}))
    path = str(tmp_path / "log")
    spark.createDataFrame([progress.note(told), progress.note(again)], progress.SCHEMA).write.parquet(path)
    row = progress.batches(spark, path).collect()
    assert [(r.run_id, r.input_rows, r.rejected_rows, r.state_rows) for r in row] == [("b", 6, None, 7)]


def test_failures_of_the_log_are_told(spark, tmp_path):
    (tmp_path / "log").write_text("a file, no folder")
    log = progress.BatchLog(spark, str(tmp_path / "log" / "below"))
    log.worker.start()
    log.notes.put(("s", "r", 0, None, 1, None, 0, 0, 1))
    log.notes.put(None)
    log.worker.join(60)
    assert len(log.failed) == 1
