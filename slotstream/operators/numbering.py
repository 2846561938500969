"""Gap-free row numbers for data of any size and skew.

A plain `row_number` puts each group, or without keys the whole table, into one task. Here
the rows are range-partitioned by keys and order, so a large group spans several
partitions; rows are numbered inside a partition and shifted by what earlier partitions hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotstream.session import materialise

PART, PLACE, SHIFT = "_part", "_place", "_shift"
# monotonically_increasing_id keeps the row's place in its partition in the lower 33 bits
PLACE_MASK = (1 << 33) - 1


def number_rows(
    df: DataFrame, order: list[str], out: str, *, keys: list[str] | None = None, start: int = 1
) -> DataFrame:
    """Adds `out`: 1, 2, 3, ... by `order`, per `keys` if given. `order` must be total: rows
    alike in it would share a partition, however many they are.

    The range-partitioned rows are written to the shared folder before they are counted and
    read again: the ranges come from a sample, and the two readers must see the same ones.
    """
    keys = keys or []
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    ranged = materialise(
        ranged.withColumns(
            {
                PART: F.spark_partition_id(),
                PLACE: F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_MASK)) + F.lit(1),
            }
        )
    )
    counts = ranged.groupBy(*keys, PART).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    # Only the first key of a partition can have started in an earlier one, so at most one
    # row per partition remains and the broadcast is bounded whatever the data.
    shifts = counts.select(
        *keys, F.col(PART).alias("_at"), F.sum("_n").over(before).alias(SHIFT)
    ).filter(F.col(SHIFT) > 0)
    here = F.col(PLACE)
    if keys:
        here = F.row_number().over(W.partitionBy(PART, *keys).orderBy(PLACE))
    numbered = ranged.withColumn(PLACE, here)
    same = F.col(f"l.{PART}") == F.col("r._at")
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    joined = numbered.alias("l").join(F.broadcast(shifts).alias("r"), same, "left")
    number = F.col(f"l.{PLACE}") + F.coalesce(F.col(f"r.{SHIFT}"), F.lit(0)) + F.lit(start - 1)
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], number.cast("long").alias(out))
