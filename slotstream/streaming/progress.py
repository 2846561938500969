"""Progress of streams as a table: rows, rejects and state of every batch, and a limit on rejects.

Spark tells a listener about every batch. The listener only takes a note; a thread of its own writes
notes to the table, many at a time, and stops streams of which too many messages were rejected.
"""

from __future__ import annotations

import datetime as dt
import json
import queue
import threading
from collections import defaultdict, deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from slotstream.operators import latest

# the observation by which a stream of rejected messages tells their number
REJECTS = "rejects"
SCHEMA = (
    "query string, run_id string, batch_id long, at timestamp, input_rows long, rejected_rows long, "
    "state_rows long, state_bytes long, millis long"
)


def counting_rejects(rejected: DataFrame) -> DataFrame:
    """`rejected` with its rows counted while they are written."""
    return rejected.observe(REJECTS, F.count(F.lit(1)).alias("rejected_rows"))


def note(progress: dict) -> tuple:
    """A row of the table from the JSON of a batch's progress."""
    states = progress.get("stateOperators") or []
    rejects = (progress.get("observedMetrics") or {}).get(REJECTS) or {}
    at = dt.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    return (
        progress.get("name"),
        progress["runId"],
        progress["batchId"],
        at,
        sum(source["numInputRows"] for source in progress["sources"]),
        rejects.get("rejected_rows"),
        sum(state["numRowsTotal"] for state in states),
        sum(state["memoryUsedBytes"] for state in states),
        progress.get("batchDuration"),
    )


class BatchLog(StreamingQueryListener):
    """Writes a row per batch below `path`; use it in a `with` statement around the streams.

    With `limit`, a stream that rejects more than this share of the messages of its last `window`
    batches, `least` messages or more, is stopped, and so are the streams `beside` gives for it by
    name. `stopped` has the names.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        limit: float | None = None,
        window: int = 10,
        least: int = 1000,
        beside: Callable[[str], list[str]] = lambda name: [],
    ):
        self.spark, self.path = spark, path
        self.limit, self.least, self.beside = limit, least, beside
        self.last: dict[str, deque[tuple[int, int]]] = defaultdict(lambda: deque(maxlen=window))
        self.stopped: list[str] = []
        self.failed: list[Exception] = []
        self.notes: queue.Queue[tuple | None] = queue.Queue()
        self.worker = threading.Thread(target=self._work, daemon=True)

    def onQueryStarted(self, event: object) -> None:
        pass

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.notes.put(note(json.loads(event.progress.json)))

    def __enter__(self) -> BatchLog:
        self.spark.streams.addListener(self)
        self.worker.start()
        return self

    def __exit__(self, *error: object) -> None:
        # streams have ended, but what they told may still be on its way to the listener
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        self.notes.put(None)
        self.worker.join()
        if self.failed and not any(error):
            raise self.failed[0]

    def _work(self) -> None:
        more = True
        while more:
            notes = [self.notes.get()]
            while not self.notes.empty():
                notes.append(self.notes.get())
            more = None not in notes
            rows = [x for x in notes if x is not None]
            try:
                for row in rows:
                    self._judge(row)
                if rows:
                    frame = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
                    frame.write.mode("append").parquet(self.path)
            except Exception as error:  # told when the log is closed; later notes are still taken
                self.failed.append(error)

    def _judge(self, row: tuple) -> None:
        name, n_input, n_rejected = row[0], row[4], row[5]
        if self.limit is None or n_rejected is None:
            return
        self.last[name].append((n_input, n_rejected))
        total = sum(x for x, _ in self.last[name])
        lost = sum(x for _, x in self.last[name])
        if total < self.least or lost <= self.limit * total or name in self.stopped:
            return
        names = [name, *self.beside(name)]
        self.stopped += names
        for stream in self.spark.streams.active:
            if stream.name in names:
                stream.stop()


def batches(spark: SparkSession, path: str) -> DataFrame:
    """A row per query and batch. Of a batch that ran again, after a restart, the last run counts."""
    return latest.replace_latest(
        spark.read.schema(SCHEMA).parquet(path), ["query", "batch_id"], ["at", "run_id"]
    )


def rates(log: DataFrame, per: str = "hour") -> DataFrame:
    """Messages, rejects and their share for each query and hour (or another `date_trunc` unit)."""
    return (
        log.groupBy("query", F.date_trunc(per, "at").alias("since"))
        .agg(
            F.count(F.lit(1)).alias("n_batches"),
            F.sum("input_rows").alias("input_rows"),
            F.sum("rejected_rows").alias("rejected_rows"),
            F.max("state_rows").alias("state_rows"),
        )
        .withColumn("reject_share", F.try_divide(F.col("rejected_rows"), F.col("input_rows")))
    )
