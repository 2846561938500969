"""Tables that change in place: a change rewrites the parts its keys lie in, and nothing else.

The operators of `operators` take whole tables and return whole tables. Here a table is kept in parts by
a hash of some of its columns (`sinks.keyed`): slots by day, bookings and log entries by slot. A
change names the keys it is about; the same operators then work on the rows of those parts, and only
they are read, shuffled and written. Readers see a change whole or not at all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from slotstream.operators import mutations, schedule, slots
from slotstream.session import materialise
from slotstream.sinks import keyed


@dataclass(frozen=True)
class Kept:
    """A table below `folder`, in parts by `keys`."""

    spark: SparkSession
    folder: str
    keys: list[str]
    schema: T.StructType

    @staticmethod
    def create(table: DataFrame, folder: str, keys: list[str], *, parts: int = keyed.PARTS) -> Kept:
        """Writes `table` as the first version."""
        keyed.fold(table, folder, keys, lambda rows: rows, 0, parts=parts, base=-1)
        return Kept(table.sparkSession, folder, keys, table.schema)

    def read(self) -> DataFrame:
        return keyed.read(self.spark, self.folder, self.schema)

    def near(self, named: DataFrame) -> DataFrame:
        """The rows of the parts in which the keys `named` lie."""
        at = keyed.upto(self.spark, self.folder)
        parts = keyed.manifest(self.spark, self.folder, at)[1]
        wanted = keyed.touched_parts(named, self.keys, parts)
        return keyed.read(self.spark, self.folder, self.schema, parts=wanted, at=at)

    def apply(self, named: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[int]:
        """`change` on the rows of the parts in which the keys `named` lie; returns the parts."""
        parts = keyed.change(named, self.folder, self.keys, self.schema, change)
        keyed.expire(self.spark, self.folder)
        return parts

    def upsert(self, new: DataFrame, keys: list[str], *, guard: mutations.Guard | None = None) -> list[int]:
        """Rows of unique `keys` written over those there, or added; see `mutations.upsert`."""
        return self.apply(new, lambda rows: mutations.upsert(rows, new, keys, guard=guard))

    def delete(self, gone: DataFrame) -> list[int]:
        """Drops the rows whose key is listed."""
        return self.apply(gone, lambda rows: mutations.delete_keys(rows, gone, self.keys))

    def update(self, changes: DataFrame, columns: list[str], *, now: Column | None = None) -> list[int]:
        """Full-row update of the keys listed; see `mutations.update_rows`."""
        return self.apply(
            changes, lambda rows: mutations.update_rows(rows, changes, self.keys, columns, now=now)
        )


def merge_slots(table: Kept, new: DataFrame) -> list[int]:
    """Generated slots merged into the table kept by day. A generated id starts with its date, so
    no other day can conflict."""
    return table.apply(new, lambda rows: schedule.merge_slots(rows, new))


def update_slots(table: Kept, updates: DataFrame, days: DataFrame, appointments: DataFrame) -> list[int]:
    """Single slots set to a status, as `slots.apply_updates` does, in the table kept by day."""
    return table.apply(updates, lambda rows: slots.apply_updates(rows, updates, days, appointments)[0])


def change_days(
    changes: DataFrame, calendar: Kept, table: Kept, appointments: Kept, transactions: Kept
) -> dict[str, list[int]]:
    """New statuses of days `(date, status)` with all that follows from them, as
    `schedule.holiday_cascade` says. The calendar and the slots are kept by day, bookings and log by
    slot. Slots change last, and doing it again gives the same, so a run that failed can be repeated.
    """
    changes = materialise(changes)
    days = changes.withColumnRenamed("date", "slot_date").select("slot_date")
    affected = materialise(table.near(days).join(days, "slot_date", "left_semi"))

    def effect(name: str) -> Callable[[DataFrame], DataFrame]:
        def apply(rows: DataFrame) -> DataFrame:
            given = {
                "days": calendar.read().limit(0),
                "transactions": transactions.read().limit(0),
                "appointments": appointments.read().limit(0),
                "slots": affected,
            }
            given["days" if name == "calendar" else name] = rows
            return schedule.holiday_cascade(changes, **given)[name]

        return apply

    return {
        "calendar": calendar.apply(changes, effect("calendar")),
        "transactions": transactions.apply(affected, effect("transactions")),
        "appointments": appointments.apply(affected, effect("appointments")),
        "slots": table.apply(days, effect("slots")),
    }
