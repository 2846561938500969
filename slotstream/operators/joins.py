"""Joins of many rows with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPREAD = 64


def lookup(many: DataFrame, one: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Joins `many` to `one`, which has one row per key, so that a hot key can be split.

    Spark can split a skewed partition of one input only if both inputs are shuffled for the
    join. Where `one` comes from an aggregate or a join on the keys, its partitioning would be
    reused and all rows of a hot key would meet in one task. Joining also on a function of
    the keys leaves the result as it is and makes Spark shuffle both inputs.
    """
    for key in keys:
        types = many.schema[key].dataType, one.schema[key].dataType
        # integers of any width hash alike as text; other types must be equal, as casts would
        # make values equal whose texts are not
        if types[0] != types[1] and not all(isinstance(t, T.IntegralType) for t in types):
            raise TypeError(f"key {key} has types {types[0]} and {types[1]}; cast one of them")
    spread = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(SPREAD))
    left, right = many.withColumn("_spread", spread), one.withColumn("_spread", spread)
    return left.join(right, [*keys, "_spread"], how).drop("_spread")


# distinct keys of a batch that are sent to all executors at most
MOST_KEYS = 100_000


def named(table: DataFrame, rows: DataFrame, key: str, *, most: int = MOST_KEYS) -> DataFrame:
    """The rows of `table` whose `key` occurs in `rows`, where those name `most` keys or fewer.

    The keys are counted first. Their range goes into the scan, which skips files and row groups
    outside it if the table is sorted by the key, and the keys themselves are broadcast, so that of
    a large table only what a batch is about is shuffled later. With more keys the table is returned
    whole. Rows without a partner are left out, so this is for one side of a join on `key`.
    """
    keys = rows.filter(F.col(key).isNotNull()).select(key).distinct()
    n, low, high = keys.limit(most + 1).agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    if n > most:
        return table
    if not n:
        return table.filter(F.lit(False))
    near = table.filter(F.col(key).between(F.lit(low), F.lit(high)))
    return near.join(F.broadcast(keys), key, "left_semi").select(*table.columns)
