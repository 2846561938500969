"""Text helpers: zero fill, composed identifiers, input formats, registration patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: patterns of valid contact data and the insurance prefixes
PHONE = r"^0\d{9}$"
EMAIL = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"
INSURANCE_DIGITS = r"^\d{13}$"
INSURANCE_PREFIXES = ["GD", "DN", "CH", "QN"]
# fixed values: texts that stand for a missing value in CSV files
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                 "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# fixed values: formats of dates and times in the input files
US_DATE = "M/d/yyyy"
TWELVE_HOUR = "yyyy-MM-dd hh:mma"


def zero_fill(value: Column, width: int) -> Column:
    """Pad with zeros on the left; longer text is never cut."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def sequence_id(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), zero_fill(number, width))


def slot_key(day: Column, doctor_id: Column, slot_code: Column) -> Column:
    return F.concat(F.date_format(day, "yyyyMMdd"), doctor_id, slot_code)


def pattern_key(weekday: Column, slot_code: Column) -> Column:
    return F.concat_ws("_", weekday.cast("string"), slot_code)


def split_pattern_key(key: Column) -> tuple[Column, Column]:
    parts = F.split(key, "_", 2)
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1))


def blank_to_null(value: Column) -> Column:
    """NULL for the texts that stand for a missing value; any other text is kept as it is."""
    return F.when(~value.isin(MISSING_TEXTS), value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def parse_twelve_hour(value: Column) -> Column:
    return F.try_to_timestamp(F.upper(value), F.lit(TWELVE_HOUR))


def parse_date(value: Column, pattern: str) -> Column:
    return F.try_to_timestamp(value, F.lit(pattern)).cast("date")


def insurance(prefix: Column, digits: Column) -> Column:
    return F.concat(prefix, digits)


def valid_insurance(value: Column) -> Column:
    return F.coalesce(value.rlike(r"^(" + "|".join(INSURANCE_PREFIXES) + r")\d{13}$"), F.lit(False))


def contains_any(columns: list[Column], keyword: str) -> Column:
    """Case-insensitive substring test over several columns."""
    needle = F.lit(keyword.lower())
    hit = F.lit(False)
    for column in columns:
        hit = hit | F.coalesce(F.contains(F.lower(column), needle), F.lit(False))
    return hit


def parse_event_time(value: Column) -> Column:
    """ISO-like text with blank or T, optional fraction, zone and Z; NULL if unreadable."""
    plain = F.replace(F.replace(F.trim(value.cast("string")), F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
    return F.coalesce(
        F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]")),
        plain.try_cast("timestamp"),
    )
