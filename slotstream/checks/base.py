"""Registry of the queries that run on the test tables, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotstream.session import materialise

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, and the SQL that must give the same rows if there is one."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def with_place(ordered: DataFrame) -> DataFrame:
    """Adds `place`: 1, 2, 3, ... in the order in which the rows of `ordered` come out.

    Rows are numbered in their partitions, which are shifted by what comes before; there is one
    row per partition to do that."""
    low = (1 << 33) - 1
    here = materialise(
        ordered.withColumns(
            {
                "_part": F.spark_partition_id(),
                "_row": F.monotonically_increasing_id().bitwiseAND(F.lit(low)) + F.lit(1),
            }
        )
    )
    counts = here.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    return here.join(F.broadcast(shifts), "_part").select(
        *ordered.columns, (F.col("_row") + F.col("_shift")).cast("long").alias("place")
    )
