"""Column decoders for the numeric encodings a change-data connector puts on the wire.

Values come from outside, so a number no calendar date can hold gives NULL instead of
failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: 0001-01-01 and 9999-12-31 as days and as seconds since 1970-01-01
MIN_DAY, MAX_DAY = -719162, 2932896
MIN_SECOND, MAX_SECOND = -62135596800, 253402300799

PRECISIONS = ("second", "full")


def days_to_date(days: Column) -> Column:
    """Days since 1970-01-01 as a DATE."""
    safe = F.when(days.between(MIN_DAY, MAX_DAY), days.cast("int"))
    return F.date_from_unix_date(safe)


def _ticks_to_ts(ticks: Column, per_second: int, precision: str) -> Column:
    if precision not in PRECISIONS:
        raise ValueError(f"precision must be one of {PRECISIONS}, not {precision!r}")
    inside = ticks.between(MIN_SECOND * per_second, (MAX_SECOND + 1) * per_second - 1)
    if precision == "second":
        # integral division truncates toward zero and stays exact for any 64-bit value
        whole = F.call_function("div", ticks, F.lit(per_second))
        return F.timestamp_seconds(F.when(inside, whole))
    safe = F.when(inside, ticks)
    return F.timestamp_millis(safe) if per_second == 1000 else F.timestamp_micros(safe)


def millis_to_ts(millis: Column, precision: str = "second") -> Column:
    """Milliseconds since the epoch as a TIMESTAMP; whole seconds unless `full`."""
    return _ticks_to_ts(millis, 1_000, precision)


def micros_to_ts(micros: Column, precision: str = "second") -> Column:
    """Microseconds since the epoch as a TIMESTAMP; whole seconds unless `full`."""
    return _ticks_to_ts(micros, 1_000_000, precision)


def time_of_day(value: Column) -> Column:
    """A TIME sent as microseconds since midnight as `HH:mm`; other text is kept."""
    micros = value.try_cast("long")
    minutes = F.call_function("div", micros, F.lit(60_000_000))
    clock = F.format_string("%02d:%02d", F.call_function("div", minutes, F.lit(60)), minutes % 60)
    return F.when(micros.between(0, 86_400_000_000 - 1), clock).otherwise(value.cast("string"))
