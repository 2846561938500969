"""Staging rows: typed business columns and the five load columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotstream.sources.registry import STAGING_TYPES, TableConfig


def to_staging(decoded: DataFrame, cfg: TableConfig, *, batch_id: int | Column) -> DataFrame:
    """Decoded rows in the column order and types of the staging table.

    The message position follows the load columns; it orders versions of a key that carry
    the same second.
    """
    batch = batch_id if isinstance(batch_id, Column) else F.lit(int(batch_id))
    return decoded.select(
        *[
            (F.col(n).try_cast("int") if k == "int" else F.col(n).cast(STAGING_TYPES[k])).alias(n)
            for n, k in cfg.fields
        ],
        "op",
        F.col("is_deleted").cast("int").alias("is_deleted"),
        "cdc_ts",
        "dw_ingested_at",
        batch.cast("long").alias("dw_batch_id"),
        "source_partition",
        "source_offset",
    )
