"""Latest version per key, in the two senses the warehouse knows.

`replace_latest` keeps the latest row. `current` keeps, per key, the latest row of the plain
columns and the latest non-NULL value of the nullable ones. Both are aggregates: every task
first reduces its own rows to one per key, so a key holding a large share of the log reaches
the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest `order` columns (NULL counts lowest)."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def needed_versions(
    df: DataFrame, keys: list[str], order: list[str], *, nullable: tuple[str, ...] = ()
) -> DataFrame:
    """The rows on which `current` rests: of each key the latest, and for each nullable column the
    latest in which it is not NULL.

    They are rows of `df` as they are, so `current` gives the same for them as for `df`,
    whatever versions are added to either, even older ones.
    """
    position = F.struct(*order)
    whole = F.struct(*df.columns)
    picked = [F.max_by(whole, position)]
    picked += [
        F.max_by(
            F.when(F.col(c).isNotNull(), whole), F.when(F.col(c).isNotNull(), position)
        )
        for c in nullable
        if c in df.columns
    ]
    rows = F.array_distinct(F.array_compact(F.array(*picked)))
    return df.groupBy(*keys).agg(rows.alias("_rows")).select(F.inline("_rows"))


def unique_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys."""
    return df.select(*keys).distinct()


def current(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    nullable: tuple[str, ...] = (),
    columns: list[str] | None = None,
    deleted: str = "is_deleted",
    updated_at: str = "dw_updated_at",
) -> DataFrame:
    """Current state of versioned rows, deleted keys left out.

    Whether a key is deleted is decided after its versions were reduced: dropping deleted
    versions first would bring a deleted key back to life.
    """
    wanted = columns or [c for c in df.columns if c not in (*keys, *order, deleted, updated_at)]
    plain = [c for c in wanted if c not in nullable]
    position = F.struct(*order)
    measures = [
        F.max_by(F.struct(*plain, deleted), position).alias("_row"),
        F.max(updated_at).alias(f"latest_{updated_at}"),
    ]
    measures += [
        F.max_by(F.when(F.col(c).isNotNull(), F.struct(c)), F.when(F.col(c).isNotNull(), position))
        .alias(f"_{c}")
        for c in wanted
        if c in nullable
    ]
    state = df.groupBy(*keys).agg(*measures)
    values = [
        (F.col(f"_{c}.{c}") if c in nullable else F.col(f"_row.{c}")).alias(c) for c in wanted
    ]
    return state.filter(F.col(f"_row.{deleted}") == 0).select(
        *keys, *values, F.col(f"_row.{deleted}").alias(deleted), f"latest_{updated_at}"
    )
