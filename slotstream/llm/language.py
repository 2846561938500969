"""Language identification by nearest centroid.

A text's vector counts its byte trigrams, letters lower-cased and all other ASCII blank, hashed to
DIMENSIONS coordinates; counts are damped by a logarithm, weighted by inverse document
frequency, and normalised. Document frequencies are counted by Spark over all training documents.
Each language gets CENTROIDS centroids by spherical k-means over a sample of SAMPLE of its
training documents on average, drawn by a hash of the row. A text has the language of the centroid of
highest cosine. It is `rejected` if it is further from that centroid than `reach` times the
furthest of the sample that belong to it.

Defined cases: NULL texts and texts without a letter are `und` with score 0, as is every text when
nothing could be learned. Rows with a NULL language, or of an empty or NULL text, teach
nothing. Repeated rows give a row each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm import words as W
from slotstream.llm.tables import read, slices, small_batches, text_bytes

DIMENSIONS = 4096
CENTROIDS = 4
SAMPLE = 400
ROUNDS = 10
REACH = 1.2
# texts whose vectors are held at once
ROWS = 1000
UNKNOWN = "und"

FOLDED = np.where(np.arange(256) < 128, 32, np.arange(256)).astype(np.uint8)
FOLDED[65:91] = FOLDED[97:123] = np.arange(97, 123)
ASCII_LETTER = FOLDED > 32
ASCII_LETTER[128:] = False
# odd factors that spread a byte over the bits of a trigram's hash
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
BITS = DIMENSIONS.bit_length() - 1


def counts(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Trigram counts of each text (a row of DIMENSIONS), and whether it has a letter."""
    data, offsets = text_bytes(part.column("text"))
    n = part.num_rows
    folded = FOLDED[data].astype(np.uint32)
    # a text is read as if blanks stood around it
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate([[32], folded[:-1]]).astype(np.uint32) if len(data) else folded
    after = np.concatenate([folded[1:], [32]]).astype(np.uint32) if len(data) else folded
    before[first[:-1]] = 32
    after[first[1:]] = 32
    hashed = before * FACTORS[0] + folded * FACTORS[1] + after * FACTORS[2]
    hashed ^= hashed >> np.uint32(15)
    place = (hashed * FACTORS[0]) >> np.uint32(32 - BITS)
    blank = (folded == 32) & ((before == 32) | (after == 32))
    row = np.repeat(np.arange(n), np.diff(offsets))
    cells = row[~blank] * DIMENSIONS + place[~blank]
    found = np.bincount(cells, minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)
    letters = W.per_row(ASCII_LETTER[data], offsets) > 0
    for i in np.flatnonzero(~letters & (np.diff(offsets) > 0)):
        own = data[offsets[i] : offsets[i + 1]]
        letters[i] = any(c.isalpha() for c in own.tobytes().decode("utf-8"))
    return found.astype(np.float32), letters


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(found) * idf
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, size, out=out, where=size > 0)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield from slices(batch.slice(at, ROWS), "text")


def frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """In how many training documents each coordinate occurs, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(DIMENSIONS, np.int64), 0
        for part in parts(batches):
            total += (counts(part)[0] > 0).sum(axis=0)
            rows += part.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(DIMENSIONS + 1)), pa.array(np.append(total, rows))],
            names=["place", "n"],
        )

    summed = train.select("text").transform(small_batches).mapInArrow(run, "place long, n long").groupBy("place")
    out = np.zeros(DIMENSIONS + 1, np.int64)
    for place, n in summed.agg(F.sum("n")).collect():  # DIMENSIONS + 1 rows
        out[place] = n
    return out[:-1], int(out[-1])


def cluster(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `k` unit centroids of the unit vectors `x`, and the lowest cosine in each."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    centre = x[chosen]
    for _ in range(ROUNDS):
        own = np.argmax(x @ centre.T, axis=1)
        sums = np.stack([x[own == c].sum(axis=0) for c in range(len(centre))])
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(size > 0, sums / np.maximum(size, 1e-12), centre)
    near = x @ centre.T
    own = np.argmax(near, axis=1)
    low = [near[own == c, c].min(initial=1.0) for c in range(len(centre))]
    return centre.astype(np.float32), np.array(low, np.float32)


class Centroids:
    """What was learned: idf weights, and centroids with their language and lowest cosine."""

    def __init__(self, idf: np.ndarray, names: list[str], centre: np.ndarray, low: np.ndarray):
        self.idf, self.names, self.centre, self.low = idf, names, centre, low

    def predict(self, part: pa.RecordBatch, reach: float):
        """Language, cosine, and whether the nearest centroid is out of reach."""
        found, letters = counts(part)
        n = len(found)
        if not self.names:
            return [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        near = vectors(found, self.idf) @ self.centre.T
        best = np.argmax(near, axis=1)
        score = np.clip(near[np.arange(n), best], 0, 1).astype(float)
        rejected = 1 - score > reach * (1 - self.low[best])
        names = [self.names[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
        return names, np.where(letters, score, 0.0), rejected | ~letters


def learn(train: DataFrame, *, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Centroids:
    """Learns from the columns `text` and `lang`."""
    train = train.select("text", "lang").filter("lang IS NOT NULL AND length(text) > 0")
    df, rows = frequencies(train)
    idf = (np.log((1 + rows) / (1 + df)) + 1).astype(np.float32)
    sizes = {r[0]: r[1] for r in train.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return Centroids(idf, [], np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, np.float32))
    spark = train.sparkSession
    share = spark.createDataFrame(
        [(name, min(1.0, sample / n)) for name, n in sizes.items()], "lang string, share double"
    )
    draw = F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = train.join(F.broadcast(share), "lang").filter(draw < F.col("share"))

    def centres(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("text")
        batch = pa.RecordBatch.from_pandas(group[["text"]], preserve_index=False)
        x = np.concatenate([vectors(counts(p)[0], idf) for p in parts(iter([batch]))])
        centre, low = cluster(x, centroids)
        return pd.DataFrame(
            {"lang": group["lang"].iloc[0], "centre": list(centre), "low": low.astype(float)}
        )

    # copies of one text are drawn together: once is enough
    found = (
        drawn.select("lang", "text")
        .distinct()
        .groupBy("lang")
        .applyInPandas(centres, "lang string, centre array<float>, low double")
        .orderBy("lang", "low")
        .collect()  # CENTROIDS rows per language
    )
    return Centroids(
        idf,
        [r["lang"] for r in found],
        np.array([r["centre"] for r in found], np.float32).reshape(-1, DIMENSIONS),
        np.array([r["low"] for r in found], np.float32),
    )


def identify(docs: DataFrame, learned: Centroids, *, reach: float = REACH) -> DataFrame:
    """`doc_id`, `lang_pred`, `score` and `rejected` of every document."""
    held = docs.sparkSession.sparkContext.broadcast(learned)  # CENTROIDS vectors per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            names, score, rejected = held.value.predict(part, reach)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array(names, pa.string()),
                    pa.array(score),
                    pa.array(rejected),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.select("doc_id", "text").transform(small_batches).mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean"
    )


def held_out(doc_id: Column) -> Column:
    """A third of the documents, by a checksum of the id; NULL ids are none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    train = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    return identify(docs, learn(train)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )
