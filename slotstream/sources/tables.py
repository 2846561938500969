"""Relational tables: JDBC with a pushed-down predicate, or files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def table(spark: SparkSession, name: str, *, root: str, fmt: str = "parquet") -> DataFrame:
    """A table stored as files below `root`."""
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}")


def jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    *,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    single: bool = False,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A database table. Filters and columns chosen later are pushed into its query.

    With `partition_column` the read is split into `partitions` ranges between `bounds`. One
    connection for the whole table, in one task, must be asked for (`single`).
    """
    if not partition_column and not single:
        raise ValueError("give a partition column with bounds, or ask for a single connection")
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", name)
        .option("fetchsize", fetch_size)
        .options(**(properties or {}))
    )
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned read needs bounds")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", partitions)
        )
    return reader.load()


def fetch_all(df: DataFrame, predicate: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows matching the predicate; Catalyst pushes it and the columns into the scan."""
    rows = df if predicate is None else df.filter(predicate)
    return rows.select(*columns) if columns else rows


def fetch_one(df: DataFrame, predicate: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """At most one matching row."""
    return fetch_all(df, predicate, columns).limit(1)
