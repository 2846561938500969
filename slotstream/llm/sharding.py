"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Documents of equal text form a group, which is placed whole unless it alone is more than a shard's
share of bytes, tokens or rows; such a group is dealt into parts by a hash of the id. Every group
goes to the shard where the dot product of its demand with the residual capacity is highest, largest
first. Groups heavier than a small share of a shard, of which there is a bounded number, are
placed first and together. The others are dealt into blocks of bounded size by a hash of their
digest; every block is packed in one task into as many bins as there are shards, which have the
block's share of what the heavy groups left of each shard. Shards, made of one bin of every block,
come out as the blocks do; each block starts at another shard, so that what is left over does
not add up.

The law is `bytes`: sizes of shards are near equal, as far as single documents allow it.

Defined cases: NULL text counts no bytes and equals the empty text. Repeated rows are
documents of their own; a NULL id is one like any other. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm.tables import read
from slotstream.operators.joins import lookup
from slotstream.operators.numbering import number_rows
from slotstream.session import materialise

SHARDS = 40
# bytes a row takes besides its text
ROW_BYTES = 16
# groups heavier than this share of a shard are placed before the blocks
GRAIN = 1 / 64
# parts for each shard's share that a group takes which no shard can hold
SPLIT = 8
BLOCK_GROUPS = 4096
DEMANDS = ["size", "tokens", "rows"]
PLACED = "content binary, part int, shard int"
WORD = r"[^\x20\x09-\x0D]+"


def place(need: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The bin of each group, from its demands and what is left in each bin (changed in place)."""
    out = np.zeros(len(need), np.int32)
    for group in np.argsort(-need.max(axis=1), kind="stable"):
        chosen = int(np.argmax(left @ need[group]))
        out[group] = chosen
        left[chosen] -= need[group]
    return out


def assign(docs: DataFrame, *, shards: int = SHARDS) -> DataFrame:
    """`doc_id`, `size`, `text_crc32`, `tokens` and `shard` of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = materialise(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
            F.unhex(F.md5(text.cast("binary"))).alias("content"),
        ).withColumn("rows", F.lit(1).cast("long"))
    )
    sums = [F.sum(c).alias(c) for c in DEMANDS]
    totals = rows.agg(*sums).first()
    groups = rows.groupBy("content").agg(*sums)
    scale = np.array([max(1, totals[c] or 0) / shards for c in DEMANDS])
    weight = F.greatest(*[F.col(c) / F.lit(float(x)) for c, x in zip(DEMANDS, scale, strict=True)])
    # weights add up to 3 * shards at most, so no more groups than that exceed a shard
    parted = groups.filter(weight > 1).filter("rows > 1").withColumn("parts", F.ceil(weight * SPLIT).cast("int"))
    dealt = rows.join(F.broadcast(parted.select("content", "parts")), "content", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"), F.lit(0))
    )
    items = materialise(dealt.groupBy("content", "part").agg(*sums))
    # no more than 3 * shards / GRAIN rows
    heavy = items.filter(weight > GRAIN).toPandas().sort_values(["content", "part"])
    left = np.ones((shards, len(DEMANDS)))
    first = heavy[["content", "part"]].assign(shard=place(heavy[DEMANDS].to_numpy(float) / scale, left))
    spark = docs.sparkSession
    first = spark.createDataFrame(first, PLACED) if len(first) else spark.createDataFrame([], PLACED)
    left = np.maximum(left, 0)
    shares = left / np.maximum(left.sum(axis=0), 1e-9) * shards
    light = items.filter(weight <= GRAIN)
    blocks = max(1, round(light.count() / BLOCK_GROUPS))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["content", "part"])
        turn = int(block["block"].iloc[0])
        demands = block[DEMANDS].to_numpy(float)
        need = demands / np.maximum(demands.sum(axis=0), 1) * shards
        bins = place(need, np.roll(shares, -turn, axis=0))
        return block[["content", "part"]].assign(shard=((bins + turn) % shards).astype(np.int32))

    placed = (
        light.withColumn("block", F.pmod(F.xxhash64("content", "part"), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(pack, PLACED)
        .unionByName(first)
    )
    return lookup(dealt.drop("parts"), placed, ["content", "part"], "inner").select(
        "doc_id", "size", "text_crc32", "tokens", "shard"
    )


def numbered(docs: DataFrame, *, shards: int = SHARDS) -> DataFrame:
    """`assign`, with the place of every row in its shard, from 0 and without gaps."""
    placed = materialise(assign(docs, shards=shards))
    return number_rows(placed, ["doc_id", "text_crc32"], "slot", keys=["shard"], start=0)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )
