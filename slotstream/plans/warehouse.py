"""Staging tables to dimensions, facts and current views."""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.operators import cdc, latest, staging, warehouse
from slotstream.session import build_session, materialise
from slotstream.sinks import keyed, writers
from slotstream.sources.registry import TABLES

# facts whose slot columns are looked up
SLOT_FACTS = ["fact_appointment", "fact_appointment_transaction", "fact_medical_record"]


def stage(
    messages: dict[str, DataFrame], *, ingested_at: Column | None = None, batch_id: int = 0
) -> dict[str, DataFrame]:
    """Staging rows of each table from its change messages, as a batch."""
    return {
        TABLES[name].staging_table: staging.to_staging(
            cdc.decode(raw, TABLES[name], ingested_at=ingested_at), TABLES[name], batch_id=batch_id
        )
        for name, raw in messages.items()
    }


def build(
    stg: dict[str, DataFrame], *, missing: str | None = "", updated_at: Column | None = None
) -> dict[str, DataFrame]:
    """All dimensions and facts. Facts meet the latest version of their slot.

    Three facts need the slots, so these are computed once and written to the shared folder.
    """
    slots = materialise(warehouse.slot_attributes(stg["stg_doctor_slot"]))
    option = {"missing": missing, "updated_at": updated_at}
    stamp = {"updated_at": updated_at}
    return {
        "dim_doctor": warehouse.dim_doctor(stg["stg_doctor"], **stamp),
        "dim_patient": warehouse.dim_patient(stg["stg_patient"], **stamp),
        "dim_slot_code": warehouse.dim_slot_code(stg["stg_slot_code_template"], **stamp),
        "dim_doctor_slot": warehouse.dim_doctor_slot(stg["stg_doctor_slot"], **stamp),
        "fact_appointment": warehouse.fact_appointment(stg["stg_appointment"], slots, **option),
        "fact_appointment_transaction": warehouse.fact_transaction(
            stg["stg_appointment_transaction"], slots, **option
        ),
        "fact_slot_daily": warehouse.fact_slot_daily(stg["stg_doctor_slot"], **stamp),
        "fact_medical_record": warehouse.fact_record(stg["stg_medical_record"], slots, **option),
    }


def current_views(
    tables: dict[str, DataFrame], slots: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The current view of every dimension and fact given.

    With `slots`, as `warehouse.slot_attributes` gives them, the slot columns of facts are looked
    up again, so facts that were written before their slot have it.
    """
    views = {}
    for name, df in tables.items():
        view = warehouse.current(df, name)
        if slots is not None and name in SLOT_FACTS:
            view = warehouse.refresh_slot_columns(view, slots)
        views[f"vw_{name}_current"] = view
    return views


def compact(table: str, versions: DataFrame) -> DataFrame:
    """The versions on which the current view of `table` rests, a few per key at most."""
    key, nullable = warehouse.CURRENT_KEYS[table]
    return latest.needed_versions(versions, [key], warehouse.order_of(versions), nullable=nullable)


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Temporary views for SQL readers."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def compacted_upto(spark: SparkSession, target: str, table: str) -> int | None:
    """The last batch that the compacted state of `table` holds."""
    return keyed.upto(spark, f"{target}/{table}")


def _batches(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    return spark.read.parquet(*[writers.batch_folder(path, n) for n in numbers])


def versions(spark: SparkSession, source: str, target: str, table: str) -> DataFrame:
    """What readers take for a table's versions: the compacted state, and the finished batches that
    came after it, of which only their own folders are read."""
    upto = compacted_upto(spark, target, table)
    later = writers.finished_batches(spark, f"{source}/{table}", upto)
    if upto is None and not later:
        raise ValueError(f"{table} has no finished batch below {source}")
    if upto is None:
        return _batches(spark, f"{source}/{table}", later)
    sample = later or [n for n in writers.finished_batches(spark, f"{source}/{table}", None) if n <= upto][-1:]
    schema = _batches(spark, f"{source}/{table}", sample).schema
    state = keyed.read(spark, f"{target}/{table}", schema)
    return state.unionByName(_batches(spark, f"{source}/{table}", later)) if later else state


def compact_table(
    spark: SparkSession, source: str, target: str, table: str, *, parts: int = keyed.PARTS, drop: bool = False
) -> int | None:
    """Takes the finished batches since the last time into the state of `table`; returns the batch
    up to which it holds.

    Only the parts whose keys the new batches change are rewritten (`sinks.keyed`); `parts` says how
    many a new state has. A batch that a stream is still writing, and what comes after it, belongs
    to the next time. With `drop`, batches the state holds and files it no longer needs are deleted.
    """
    upto = compacted_upto(spark, target, table)
    finished = writers.finished_batches(spark, f"{source}/{table}", upto)
    if finished:
        key, _ = warehouse.CURRENT_KEYS[table]
        upto = finished[-1]
        new = _batches(spark, f"{source}/{table}", finished)
        keyed.fold(new, f"{target}/{table}", [key], lambda rows: compact(table, rows), upto, parts=parts)
    if drop and upto is not None:
        keyed.expire(spark, f"{target}/{table}")
        writers.drop_batches(spark, f"{source}/{table}", upto)
    return upto


def compact_all(spark: SparkSession, source: str, target: str, *, drop: bool = False) -> dict[str, int | None]:
    """Every dimension and fact below `source`, compacted below `target`."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("the compacted tables need a path of their own")
    return {
        table: compact_table(spark, source, target, table, drop=drop) for table in warehouse.CURRENT_KEYS
    }


def main() -> None:
    """Bring the compacted state of the warehouse tables up to the newest batch."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--source", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--drop", action="store_true", help="delete batches and files that are no longer needed")
    args = parser.parse_args()
    spark = build_session("warehouse-compaction")
    for table, upto in compact_all(spark, args.source, args.target, drop=args.drop).items():
        print(f"{table}: state holds batches up to {upto}")


if __name__ == "__main__":
    main()
