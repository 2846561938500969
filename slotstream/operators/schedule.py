"""Calendar, slot template, availability preview, month generation, holiday cascade."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.functions import calendar, text
from slotstream.operators import latest, mutations
from slotstream.operators.joins import lookup
from slotstream.session import materialise

# fixed values: the half-hour slots of a day
SLOT_TEMPLATE = [
    ("8A", "08:00", "08:30", 1),
    ("8B", "08:30", "09:00", 2),
    ("9A", "09:00", "09:30", 3),
    ("9B", "09:30", "10:00", 4),
    ("10A", "10:00", "10:30", 5),
    ("10B", "10:30", "11:00", 6),
    ("11A", "11:00", "11:30", 7),
    ("11B", "11:30", "12:00", 8),
    ("13A", "13:00", "13:30", 9),
    ("13B", "13:30", "14:00", 10),
    ("14A", "14:00", "14:30", 11),
    ("14B", "14:30", "15:00", 12),
    ("15A", "15:00", "15:30", 13),
    ("15B", "15:30", "16:00", 14),
    ("16A", "16:00", "16:30", 15),
    ("16B", "16:30", "17:00", 16),
]
# fixed values: range of the calendar and of the month locks, and the preview threshold
CALENDAR_FIRST, CALENDAR_LAST = dt.date(2026, 1, 1), dt.date(2050, 12, 31)
LOCKS_FIRST, LOCKS_LAST = dt.date(2026, 5, 1), dt.date(2050, 12, 1)
GREEN_FROM = 2

GREEN, RED = "GREEN", "RED"


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    """First day of the month and first day of the next."""
    return dt.date(year, month, 1), dt.date(year + month // 12, month % 12 + 1, 1)


def previous_month(year: int, month: int) -> tuple[int, int]:
    return (year - 1, 12) if month == 1 else (year, month - 1)


def following_month(day: dt.date) -> tuple[int, int]:
    return (day.year + 1, 1) if day.month == 12 else (day.year, day.month + 1)


def slot_template(spark: SparkSession) -> DataFrame:
    """The template as a table of 16 rows."""
    return spark.createDataFrame(
        SLOT_TEMPLATE, "slot_code string, start_time string, end_time string, display_order int"
    )


def slot_codes() -> Column:
    """The template codes as an array: exploding it replaces a product with the template."""
    return F.array(*[F.lit(code) for code, _, _, _ in SLOT_TEMPLATE])


def display_order(slot_code: Column) -> Column:
    return F.nullif(F.array_position(slot_codes(), slot_code), F.lit(0)).cast("int")


def date_series(spark: SparkSession, first: dt.date, last: dt.date, step: str = "1 day") -> DataFrame:
    """Dates from `first` to `last` in one column `date`."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr(f"interval {step}"))
    return spark.range(1).select(F.explode(days).alias("date"))


def classify_days(dates: DataFrame, column: str = "date") -> DataFrame:
    """Calendar rows for a column of dates."""
    day = F.col(column)
    return dates.select(
        day.alias("date"),
        calendar.day_status(day).alias("status"),
        calendar.weekday_name(day).alias("weekday_name"),
    )


def calendar_days(
    spark: SparkSession, first: dt.date = CALENDAR_FIRST, last: dt.date = CALENDAR_LAST
) -> DataFrame:
    return classify_days(date_series(spark, first, last))


def calendar_range(days: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return days.filter(F.col("date").between(F.lit(first), F.lit(last))).orderBy("date")


def month_locks(
    doctors: DataFrame, first: dt.date = LOCKS_FIRST, last: dt.date = LOCKS_LAST
) -> DataFrame:
    """An open lock per doctor and month."""
    months = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    return doctors.select("doctor_id", F.explode(months).alias("_month")).select(
        "doctor_id",
        F.year("_month").alias("year"),
        F.month("_month").alias("month"),
        F.lit(False).alias("is_inserted"),
    )


def month_status(locks: DataFrame, doctor_id: str | None, year: int, month: int) -> DataFrame:
    """Lock state of one month, of one doctor or of all."""
    rows = locks.filter((F.col("year") == year) & (F.col("month") == month))
    if doctor_id is not None:
        rows = rows.filter(F.col("doctor_id") == doctor_id)
    return rows.select("doctor_id", "is_inserted")


def preview(slots: DataFrame, year: int, month: int, doctor_id: str | None = None) -> DataFrame:
    """Available slots of the month before, counted per doctor, weekday and code.

    GREEN where the slot was available at least twice, else RED. Sundays do not count.
    """
    first, _ = month_bounds(*previous_month(year, month))
    end, _ = month_bounds(year, month)
    rows = slots if doctor_id is None else slots.filter(F.col("doctor_id") == doctor_id)
    day = F.col("slot_date")
    open_slots = rows.filter(
        (F.col("slot_status") == "AVAILABLE")
        & (day >= F.lit(first))
        & (day < F.lit(end))
        & (calendar.iso_weekday(day) < calendar.SUNDAY)
    )
    counts = open_slots.groupBy("doctor_id", calendar.iso_weekday(day).alias("dow"), "slot_code").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    flag = F.when(F.col("cnt") >= GREEN_FROM, F.lit(GREEN)).otherwise(F.lit(RED))
    return counts.withColumn("flag", flag)


def green(previewed: DataFrame) -> DataFrame:
    """The choices a preview proposes."""
    return previewed.filter(F.col("flag") == GREEN).select("doctor_id", "dow", "slot_code")


def _week_grid(doctors: DataFrame) -> DataFrame:
    """Every weekday but Sunday and every code, per doctor."""
    weekdays = F.sequence(F.lit(1), F.lit(calendar.SUNDAY - 1))
    days = doctors.select("doctor_id", F.explode(weekdays).alias("dow"))
    return days.select("doctor_id", "dow", F.explode(slot_codes()).alias("slot_code"))


def preview_grid(doctors: DataFrame, previewed: DataFrame) -> DataFrame:
    """The whole week per doctor: AVAILABLE where the preview is GREEN, else NOT AVAILABLE."""
    joined = _week_grid(doctors).join(
        previewed.select("doctor_id", "dow", "slot_code", "flag"),
        ["doctor_id", "dow", "slot_code"],
        "left",
    )
    state = F.when(F.col("flag") == GREEN, F.lit("AVAILABLE")).otherwise(F.lit("NOT AVAILABLE"))
    return joined.select("doctor_id", "dow", "slot_code", state.alias("state"))


def grid_choices(grid: DataFrame) -> DataFrame:
    """The cells of a (possibly edited) grid that are to be opened."""
    return grid.filter(F.col("state") == "AVAILABLE").select("doctor_id", "dow", "slot_code")


def generate(
    doctors: DataFrame, choices: DataFrame, days: DataFrame, year: int, month: int
) -> DataFrame:
    """Slots of one month for every doctor given: all days but Sundays, all codes.

    `choices (doctor_id, dow, slot_code)` are available; holidays are blocked by the
    administrator; the rest is blocked. The choices are joined to the week, not to the
    month, and the dates of each weekday are filled in afterwards.
    """
    first, end = month_bounds(year, month)
    last = end - dt.timedelta(days=1)
    picked = choices.select("doctor_id", "dow", "slot_code", F.lit(True).alias("_open")).distinct()
    week = _week_grid(doctors.select("doctor_id").distinct()).join(
        picked, ["doctor_id", "dow", "slot_code"], "left"
    )
    month_days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    dated = week.withColumn(
        "slot_date",
        F.explode(F.filter(month_days, lambda d: calendar.iso_weekday(d) == F.col("dow"))),
    )
    # distinct dates within one month: at most 31 rows
    holidays = (
        days.filter(F.col("date").between(F.lit(first), F.lit(last)) & (F.col("status") == "HOLIDAY"))
        .select(F.col("date").alias("slot_date"), F.lit(True).alias("_holiday"))
        .distinct()
    )
    joined = dated.join(F.broadcast(holidays), "slot_date", "left")
    slot_status = (
        F.when(F.col("_holiday"), F.lit("BLOCKED"))
        .when(F.col("_open"), F.lit("AVAILABLE"))
        .otherwise(F.lit("BLOCKED"))
    )
    admin_status = F.when(F.col("_holiday"), F.lit("BLOCKED")).otherwise(F.lit("AVAILABLE"))
    return joined.select(
        text.slot_key(F.col("slot_date"), F.col("doctor_id"), F.col("slot_code")).alias("slot_id"),
        "doctor_id",
        "slot_date",
        "slot_code",
        slot_status.alias("slot_status"),
        admin_status.alias("admin_status"),
    )


def merge_slots(current: DataFrame, new: DataFrame) -> DataFrame:
    """Generated slots merged in: a booked slot stays booked, the admin status is replaced."""
    keep = F.col("cur.slot_status") == "BOOKED"
    guard = {c: F.col(f"cur.{c}") for c in ("doctor_id", "slot_date", "slot_code")}
    guard["slot_status"] = F.when(keep, F.col("cur.slot_status")).otherwise(F.col("new.slot_status"))
    return mutations.upsert(current, new, ["slot_id"], guard=guard)


def _in_month(year: int, month: int) -> Column:
    first, end = month_bounds(year, month)
    return (F.col("slot_date") >= F.lit(first)) & (F.col("slot_date") < F.lit(end))


def merged_month(slots: DataFrame, new: DataFrame, year: int, month: int) -> DataFrame:
    """That month of the table, with the slots generated for it merged in.

    A generated id starts with its date, so no other month can conflict and none is read.
    """
    return merge_slots(slots.filter(_in_month(year, month)), new)


def merge_month(slots: DataFrame, new: DataFrame, year: int, month: int) -> DataFrame:
    """The whole table with the merged month; only that month is shuffled."""
    others = slots.filter(~_in_month(year, month))
    return others.unionByName(merged_month(slots, new, year, month))


def lock_months(locks: DataFrame, doctors: DataFrame, year: int, month: int) -> DataFrame:
    """Locks with the month set as generated for the doctors given."""
    done = doctors.select(
        "doctor_id",
        F.lit(year).alias("year"),
        F.lit(month).alias("month"),
        F.lit(True).alias("is_inserted"),
    )
    return mutations.upsert(locks, done, ["doctor_id", "year", "month"])


@dataclass(frozen=True)
class MonthPlan:
    """Result of a month's generation.

    Who got slots, the new slots, the month as merged, and both tables as a whole.
    """

    doctors: DataFrame
    generated: DataFrame
    month: DataFrame
    slots: DataFrame
    locks: DataFrame


def confirm(
    doctors: DataFrame,
    choices: DataFrame,
    slots: DataFrame,
    locks: DataFrame,
    days: DataFrame,
    year: int,
    month: int,
) -> MonthPlan:
    """Generate one month for the doctors given, merge it and lock the month."""
    new = generate(doctors, choices, days, year, month)
    return MonthPlan(
        doctors,
        new,
        merged_month(slots, new, year, month),
        merge_month(slots, new, year, month),
        lock_months(locks, doctors, year, month),
    )


def auto_generate(
    doctors: DataFrame, slots: DataFrame, locks: DataFrame, days: DataFrame, today: dt.date
) -> MonthPlan:
    """Next month for all doctors at once, from last month's pattern.

    Doctors whose month is locked, or whose preview has nothing GREEN, are left alone. The
    choices, at most 96 per doctor, are written once and used several times.
    """
    year, month = following_month(today)
    locked = month_status(locks, None, year, month).filter(F.col("is_inserted"))
    choices = materialise(green(preview(slots, year, month)))
    due = (
        doctors.select("doctor_id")
        .join(locked.select("doctor_id"), "doctor_id", "left_anti")
        .join(choices.select("doctor_id"), "doctor_id", "left_semi")
    )
    return confirm(due, choices, slots, locks, days, year, month)


def holiday_cascade(
    changes: DataFrame,
    days: DataFrame,
    transactions: DataFrame,
    appointments: DataFrame,
    slots: DataFrame,
) -> dict[str, DataFrame]:
    """Effects of changed day statuses `changes (date, status)`, one row per date.

    HOLIDAY cancels every log entry of the day's slots, deletes their bookings, blocks the
    slots and frees the booked ones. Any other status lifts the block.
    """
    new = changes.select(F.col("date"), F.col("status").alias("_new"))
    calendar_rows = days.join(new, "date", "left").withColumn(
        "status", F.coalesce("_new", "status")
    )
    by_day = lookup(slots, new.withColumnRenamed("date", "slot_date"), ["slot_date"])
    is_holiday = F.col("_new") == "HOLIDAY"
    slot_rows = by_day.withColumns(
        {
            "admin_status": F.when(is_holiday, F.lit("BLOCKED"))
            .when(F.col("_new").isNotNull(), F.lit("AVAILABLE"))
            .otherwise(F.col("admin_status")),
            "slot_status": F.when(
                is_holiday & (F.col("slot_status") == "BOOKED"), F.lit("AVAILABLE")
            ).otherwise(F.col("slot_status")),
        }
    )
    closed = latest.unique_keys(
        lookup(
            slots.select("slot_id", "slot_date"),
            new.filter(is_holiday).select(F.col("date").alias("slot_date")),
            ["slot_date"],
            "left_semi",
        ),
        ["slot_id"],
    )
    marked = lookup(transactions, closed.withColumn("_closed", F.lit(True)), ["slot_id"])
    action = F.when(F.col("_closed"), F.lit("CANCELLED")).otherwise(F.col("action"))
    return {
        "calendar": calendar_rows.select(*days.columns),
        "transactions": marked.withColumn("action", action).select(*transactions.columns),
        "appointments": lookup(appointments, closed, ["slot_id"], "left_anti").select(*appointments.columns),
        "slots": slot_rows.select(*slots.columns),
    }
