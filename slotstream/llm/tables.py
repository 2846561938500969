"""Test tables, and Arrow batches cut to a bounded number of bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# text that a task works on at once; its arrays take up to some 50 bytes for each
SLICE_BYTES = 1 << 20


# rows that go to a Python worker at once: whole texts, so far fewer than Spark's default
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """`df`, whose session hands rows to Python in batches of BATCH_ROWS at most from now on.

    Batches lie outside the heap, in the executor's JVM and in its Python workers."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(BATCH_SETTING, BATCH_ROWS)
    return df


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and where each row starts and the last
    one ends. NULL counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


# what frees memory that a worker holds from one task to the next
HELD: list[Callable[[], None]] = []


def slices(
    batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES, *, hold: bool = False
) -> Iterator[pa.RecordBatch]:
    """The rows of `batch` in order, in pieces of about `most` bytes of `text`; a longer text
    makes a piece of its own.

    Spark uses a worker for tasks of all kinds. Unless they ask to `hold` it, tasks give back
    what earlier ones have remembered there."""
    if not hold:
        for free in HELD:
            free()
    _, at = text_bytes(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def long_array(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64, copy=False))
