"""Token counts behind a cache keyed by digests of content and tokenizer version.

A text's key is the SHA-256 of its content, normalised only as far as the counts cannot
change (NULL is empty), next to the SHA-256 of the tokenizer's file. Documents are joined to
the stored counts by these keys; of the texts without one, each distinct one is encoded once,
and its count is appended to the cache.

Defined cases: NULL and empty texts have 0 tokens. Repeated rows and NULL ids give a row each;
rows of equal text and id, or without one, are encoded once in each task that meets them.
An empty table gives no rows and appends nothing. Counts appended twice, by a task that ran
again or by two jobs at once, are equal and count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm.encode import encoder
from slotstream.llm.packing import vocabulary
from slotstream.llm.tables import read, slices, small_batches
from slotstream.operators.joins import lookup
from slotstream.session import materialise, run_dir

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
CACHE = "content binary, version string, n_tokens long"


def version_of(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        text.alias("text"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("content"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def encoded(texts: DataFrame, path: str) -> DataFrame:
    """`content` and the token count of each text; equal ones of a task are encoded once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            fresh = []
            for content in batch.column("content").to_pylist():
                fresh.append(content not in seen)
                seen.add(content)
            for part in slices(batch.filter(pa.array(fresh, pa.bool_())), "text", hold=True):
                found = encoder(path).counts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("content"), pa.array(found, pa.int64())],
                    names=["content", "n_tokens"],
                )

    return texts.select("content", "text").transform(small_batches).mapInArrow(count, "content binary, n_tokens long")


def counts(docs: DataFrame, path: str, cache: str, *, limit: int = LIMIT) -> DataFrame:
    """Token counts of all `docs`. `cache` is the folder of the stored counts, read and
    appended to; it need not exist."""
    spark = docs.sparkSession
    version = version_of(path)
    rows = keyed(docs)
    # one row per distinct text, picked by id before any text moves
    keys = materialise(rows.select("doc_id", "content", "n_bytes"))
    distinct = keys.groupBy("content").agg(F.min("doc_id").alias("doc_id"))
    if stored(spark, cache):
        known = spark.read.schema(CACHE).parquet(cache).filter(F.col("version") == version)
        distinct = distinct.join(known, "content", "left_anti")
    # joined on the content too, as rows may share an id; a NULL id is its texts' only one
    first = rows.alias("r").join(
        distinct.alias("d"),
        F.col("r.content").eqNullSafe(F.col("d.content"))
        & F.col("r.doc_id").eqNullSafe(F.col("d.doc_id")),
        "left_semi",
    )
    # rows may share text and id, so this may be several rows; each task encodes a text once
    new = encoded(first, path).withColumn("version", F.lit(version))
    new.select("content", "version", "n_tokens").write.mode("append").parquet(cache)
    known = (
        spark.read.schema(CACHE)
        .parquet(cache)
        .filter(F.col("version") == version)
        .groupBy("content")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    return lookup(keys, known, ["content"]).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def stored(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts with an empty cache."""
    path = vocabulary(VOCABULARY)
    return counts(read(spark, sf_dir, "documents"), path, run_dir(spark, "token-counts"))
