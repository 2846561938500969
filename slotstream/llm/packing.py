"""Packing of token sequences into windows of fixed capacity by minimum bin slack.

Every document becomes its token ids and a closing id, cut into pieces: full windows and one
remainder. How pieces share windows depends on their lengths alone, so the plan is made from
a histogram, which has at most `capacity` rows whatever the data. A bitset subset-sum dynamic
programme picks the multiset of remaining lengths that fills a window closest to capacity; its
counts are read back from the bitsets, and the window is repeated while its lengths last.
Pieces of each length are then numbered, and the number gives the window and the place in it.

Defined cases: NULL text is empty, and an empty document is the closing id alone. Rows are
documents, so repeated rows and rows with a NULL id are packed each by itself; pieces of equal
id and start take places in any order. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm.encode import encoder
from slotstream.llm.tables import long_array, read, slices, small_batches
from slotstream.operators.numbering import number_rows
from slotstream.session import materialise

CAPACITY = 1024
VOCABULARY = "byte_bpe_50k.json"
CLOSING_ID = 0

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(
    docs: DataFrame, path: str, *, capacity: int = CAPACITY, closing: int = CLOSING_ID
) -> DataFrame:
    """The pieces of every document, with the checksum of their ids (little-endian, 32 bits)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", hold=True):
                texts = [x or "" for x in part.column("text").to_pylist()]
                doc, start, length, crc, total = [], [], [], [], []
                for row, ids in enumerate(encoder(path).ids(texts)):
                    raw = np.append(ids, np.uint32(closing)).astype("<u4").tobytes()
                    n = len(ids) + 1
                    for at in range(0, n, capacity):
                        size = min(capacity, n - at)
                        doc.append(row)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(raw[4 * at : 4 * (at + size)]))
                        total.append(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(doc, pa.int64())).cast(pa.int64()),
                        *(long_array(np.array(x, np.int64)) for x in (start, length, crc, total)),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return docs.select("doc_id", "text").transform(small_batches).mapInArrow(cut, PIECES)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset, as counts by length, that holds the largest length left and comes closest
    to `capacity`. Among equals it takes the larger lengths and leaves the small ones."""
    first = max(counts)
    room = capacity - first
    left = {n: c - (n == first) for n, c in counts.items() if n <= room}
    mask = (1 << (room + 1)) - 1
    reach, before = 1, []
    for length in sorted(left, reverse=True):
        before.append((length, reach))
        copies, step = min(left[length], room // length), 1
        while copies:
            step = min(step, copies)
            reach |= (reach << (length * step)) & mask
            copies -= step
            step *= 2
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    chosen = {first: 1}
    for length, earlier in reversed(before):
        taken = 0
        while not earlier >> (best - taken * length) & 1:
            taken += 1
        if taken:
            chosen[length] = chosen.get(length, 0) + taken
            best -= taken * length
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Rows (length, first, last, per_window, sequence, offset, filled): the pieces of a length
    numbered from `first` up to `last`, excluded, go `per_window` at a time to the windows from
    `sequence` on, end to end from `offset`; these windows hold `filled` ids."""
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        chosen = fill(left, capacity)
        times = min(left[n] // c for n, c in chosen.items())
        filled, offset = sum(n * c for n, c in chosen.items()), 0
        for n, c in sorted(chosen.items(), reverse=True):
            rows.append((n, used[n], used[n] + c * times, c, sequence, offset, filled))
            offset += n * c
            used[n] += c * times
            left[n] -= c * times
            if not left[n]:
                del left[n]
        sequence += times
    return rows


def pack(
    docs: DataFrame, path: str, *, capacity: int = CAPACITY, closing: int = CLOSING_ID
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    `sequence_tokens` is what the sequence holds; `padded_to` is the capacity, or
    `sequence_tokens` itself where that is a power of two."""
    spark = docs.sparkSession
    # encoded once, although ranges are sampled before rows are numbered
    cut = materialise(pieces(docs, path, capacity=capacity, closing=closing))
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # <= capacity rows
    rows = plan(counts, capacity)
    windows = spark.createDataFrame(
        rows,
        "length long, _first long, _last long, _per long, _sequence long, _offset long, "
        "sequence_tokens long",
    )
    ranked = number_rows(cut, ["doc_id", "start"], "_rank", keys=["length"], start=0)
    # a length has at most as many plan rows as there are kinds of windows
    placed = ranked.join(F.broadcast(windows), "length").filter(
        (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_last"))
    )
    here = F.col("_rank") - F.col("_first")
    filled = F.col("sequence_tokens")
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("_sequence") + F.floor(here / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(here, F.col("_per")) * F.col("length")).alias("offset"),
        "sequence_tokens",
        F.when(F.bit_count(filled) == 1, filled).otherwise(F.lit(capacity)).alias("padded_to"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), vocabulary(VOCABULARY))
