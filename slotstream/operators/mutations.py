"""Inserts, updates, upserts and deletes as functions from snapshots to a new snapshot.

Callers write the result to a new path; a path is never read and overwritten at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotstream.functions import text
from slotstream.operators import latest
from slotstream.operators.joins import lookup
from slotstream.operators.numbering import number_rows

Guard = dict[str, Column]


def _first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key by `order`; partial results are combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*(order or rest))).alias("_row")
    )
    return picked.select(*keys, "_row.*").select(*df.columns)


def accepted_inserts(
    current: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """The new rows an insert that ignores conflicts takes: one per key not there yet."""
    return _first_per_key(new, keys, order or []).join(current.select(*keys), keys, "left_anti")


def insert_ignore(
    current: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Current rows plus the new rows whose key is not there yet.

    Of several new rows with one key the first by `order` counts (default: all columns).
    """
    return current.unionByName(accepted_inserts(current, new, keys, order).select(*current.columns))


def upsert(
    current: DataFrame, new: DataFrame, keys: list[str], *, guard: Guard | None = None
) -> DataFrame:
    """Current rows overwritten by, or joined with, new rows of unique key.

    Columns the new rows lack are kept. `guard` replaces the value of a column on conflict;
    it may use the columns as `cur.<name>` and `new.<name>`.
    """
    changed = [c for c in new.columns if c not in keys]
    here = current.withColumn("_here", F.lit(True)).alias("cur")
    there = new.withColumn("_there", F.lit(True)).alias("new")
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(f"cur.{key}") == F.col(f"new.{key}"))
    both = here.join(there, same, "full")
    matched = F.col("cur._here") & F.col("new._there")
    out = []
    for name in current.columns:
        if name in keys:
            value = F.coalesce(F.col(f"cur.{name}"), F.col(f"new.{name}"))
        elif name in changed:
            fresh = F.col(f"new.{name}")
            if guard and name in guard:
                fresh = F.when(matched, guard[name]).otherwise(fresh)
            value = F.when(F.col("new._there"), fresh).otherwise(F.col(f"cur.{name}"))
        else:
            value = F.col(f"cur.{name}")
        out.append(value.alias(name))
    return both.select(*out)


def delete_keys(current: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows whose key is not listed."""
    return lookup(current, latest.unique_keys(keys_df, keys), keys, "left_anti").select(*current.columns)


def update_rows(
    current: DataFrame,
    changes: DataFrame,
    keys: list[str],
    columns: list[str],
    *,
    now: Column | None = None,
    touched: str = "updated_at",
) -> DataFrame:
    """Full-row update: listed columns take the new value, NULL if the change lacks them.

    `changes` has one row per key; keys that are not there are ignored. With `now`, changed
    rows also get it as `touched`.
    """
    new = changes.select(
        *keys,
        *[(F.col(c) if c in changes.columns else F.lit(None)).alias(f"_new_{c}") for c in columns],
        F.lit(True).alias("_hit"),
    )
    joined = current.join(new, keys, "left")
    values = {
        c: F.when(F.col("_hit"), F.col(f"_new_{c}").cast(current.schema[c].dataType)).otherwise(F.col(c))
        for c in columns
    }
    if now is not None:
        values[touched] = F.when(F.col("_hit"), now).otherwise(F.col(touched))
    return joined.withColumns(values).select(*current.columns)


def with_sequence_ids(
    df: DataFrame,
    order: list[str],
    out: str,
    *,
    prefix: str | None = None,
    width: int = 0,
    start: int = 1,
) -> DataFrame:
    """Adds generated keys: `start`, `start + 1`, ... by `order`, formatted if a prefix is given."""
    numbered = number_rows(df, order, "_number", start=start)
    number = F.col("_number")
    made = number if prefix is None else text.sequence_id(prefix, number, width)
    return numbered.select(*df.columns, made.alias(out))


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """NULLs of the named columns replaced; the column types are kept."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
            for c, v in defaults.items()
        }
    )


# fixed values: what a payment gets where the input leaves it out
PAYMENT_DEFAULTS = {
    "amount_covered": 0,
    "amount_patient_responsibility": 0,
    "payment_status": "PENDING",
}

# fixed values: the columns of the payment table and their types
PAYMENT_COLUMNS = {
    "payment_id": "long",
    "appointment_id": "int",
    "amount_total": "decimal(12,2)",
    "amount_covered": "decimal(12,2)",
    "amount_patient_responsibility": "decimal(12,2)",
    "payment_status": "string",
    "created_at": "timestamp",
    "updated_at": "timestamp",
}


def payment_rows(payments: DataFrame, *, now: Column | None = None) -> DataFrame:
    """Rows to append to the payment table: its columns and types, defaults where the input leaves
    a value out or has no such column, and the time of the insert."""
    clock = F.current_timestamp() if now is None else now
    given = {
        c: (F.col(c) if c in payments.columns else F.lit(None)).cast(kind).alias(c)
        for c, kind in PAYMENT_COLUMNS.items()
    }
    given["created_at"], given["updated_at"] = clock.alias("created_at"), clock.alias("updated_at")
    return with_defaults(payments.select(*given.values()), PAYMENT_DEFAULTS)


def append_payments(current: DataFrame, payments: DataFrame, *, now: Column | None = None) -> DataFrame:
    """The payment table with new payments appended."""
    return current.select(*PAYMENT_COLUMNS).unionByName(payment_rows(payments, now=now))
