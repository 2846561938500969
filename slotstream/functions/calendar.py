"""Calendar columns: weekday numbers and names, day status, month arithmetic, date rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: (month, day) of the public holidays, and weekday names by ISO number
HOLIDAYS = [(1, 1), (4, 30), (5, 1)]
WEEKDAYS = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]
SUNDAY = 7


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + F.lit(1)


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), iso_weekday(day))


def day_status(day: Column) -> Column:
    """HOLIDAY on the fixed dates, else WEEKEND on Sunday, else NORMAL_DAY."""
    on_holiday = F.lit(False)
    for month, dom in HOLIDAYS:
        on_holiday = on_holiday | ((F.month(day) == month) & (F.dayofmonth(day) == dom))
    return (
        F.when(on_holiday, F.lit("HOLIDAY"))
        .when(iso_weekday(day) == SUNDAY, F.lit("WEEKEND"))
        .otherwise(F.lit("NORMAL_DAY"))
    )


def month_start(day: Column, shift: int = 0) -> Column:
    """First day of the month `shift` months away."""
    return F.add_months(F.trunc(day, "month"), shift)


def month_end(day: Column) -> Column:
    return F.last_day(day)


def lead_time_ok(day: Column, today: Column) -> Column:
    """A booking needs two days of notice."""
    return F.coalesce(day >= F.date_add(today, 2), F.lit(False))


def slot_editable(day: Column, today: Column) -> Column:
    """A doctor may change a slot only before its day comes."""
    return F.coalesce(day > today, F.lit(False))


def month_editable(day: Column, today: Column) -> Column:
    """An administrator may change days from the month after next on."""
    return F.coalesce(day >= month_start(today, 2), F.lit(False))


def selectable_months(today: Column, last: str = "2050-12-01") -> Column:
    """Array of month starts from the month after next to `last`."""
    first, end = month_start(today, 2), F.lit(last).cast("date")
    return F.when(
        first <= end, F.sequence(first, end, F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))
