"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotstream.operators.joins import lookup
from slotstream.session import materialise


def components(links: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node it can reach, for every node in `links` (a, b).

    Large and small stars in turn, until nothing changes: first the larger neighbours of a
    node are linked to its smallest, then the smaller ones. Links of a hub are reduced by
    an aggregate and looked up by a join that can be split, never gathered. Every round is
    written, so that a lost executor costs no earlier round."""

    def nearest(pairs: DataFrame) -> DataFrame:
        """(u, v) with the smallest of v and u itself, per u."""
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return lookup(pairs, low, ["u"], "inner").withColumn("m", F.least("u", "m"))

    def signature(pairs: DataFrame) -> tuple:
        return tuple(
            pairs.agg(
                F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))
            ).first()
        )

    a, b = F.col("a"), F.col("b")
    pairs = links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = materialise(pairs.distinct())
    before = signature(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            nearest(both)
            .filter((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        near = nearest(large)
        small = (
            near.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(near.select("u", F.col("m").alias("v")))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        pairs = materialise(small)
        now = signature(pairs)
        if now == before:
            break
        before = now
    # every pair now leads to the smallest node, which has no pair of its own
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
