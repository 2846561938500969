"""The monthly schedule job, for any external scheduler to start on a month's last evening."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.operators import schedule
from slotstream.session import build_session, drop_materialised, exists
from slotstream.sources.tables import table


def month_slots(slots: DataFrame, today: dt.date) -> DataFrame:
    """The slots that take part: the month of `today`, which is previewed, and the one after it.
    Where the table is partitioned by month, no other is read."""
    if "slot_month" not in slots.columns:
        return slots
    year, month = schedule.following_month(today)
    months = [today.strftime("%Y-%m"), f"{year:04d}-{month:02d}"]
    return slots.filter(F.col("slot_month").cast("string").isin(months)).drop("slot_month")


def run(spark: SparkSession, source: str, target: str, today: dt.date) -> str:
    """Generate next month for all doctors; read tables below `source`, write below `target`.

    Of the slots only the month is written, as partition `slot_month=<yyyy-mm>`: it takes the
    place of that month in the table, whose other months stay as they are. Returns its path.

    The locks are written last and end the job: without them a rerun starts over and replaces
    what is there, with them it is refused.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("the new rows need a path of their own")
    year, month = schedule.following_month(today)
    folder = f"{target.rstrip('/')}/doctor_slot/slot_month={year:04d}-{month:02d}"
    locks = f"{target.rstrip('/')}/doctor_insert_month"
    if exists(spark, f"{locks}/_SUCCESS"):
        raise ValueError(f"{locks} is there: the month is done")
    slots = month_slots(table(spark, "doctor_slot", root=source), today)
    plan = schedule.auto_generate(
        table(spark, "doctor", root=source),
        slots,
        table(spark, "doctor_insert_month", root=source),
        table(spark, "calendar_day", root=source),
        today,
    )
    plan.month.write.mode("overwrite").parquet(folder)
    plan.locks.write.mode("overwrite").parquet(locks)
    return folder


def main() -> None:
    """Next month's slots for all doctors whose month is still open."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--source", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--today", type=dt.date.fromisoformat, default=dt.date.today())
    args = parser.parse_args()
    spark = build_session("monthly-schedule")
    run(spark, args.source, args.target, args.today)
    drop_materialised(spark)


if __name__ == "__main__":
    main()
