"""Constraints as audits, batch metrics, registration rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotstream.functions import status, text
from slotstream.operators import latest
from slotstream.operators.joins import lookup


def _metrics(pk: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(pk).isNull()).alias("null_key_rows"),
        F.count_if(F.col(pk).isNotNull()).alias("clean_rows"),
    ]


def batch_metrics(df: DataFrame, pk: str) -> DataFrame:
    """Rows in total, without key, and with key, as one row."""
    return df.agg(*_metrics(pk))


def observed(df: DataFrame, pk: str, name: str) -> tuple[DataFrame, Observation]:
    """`df` and the same counts, taken while `df` is written: no extra pass."""
    observation = Observation(name)
    return df.observe(observation, *_metrics(pk)), observation


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by several rows. As in a unique constraint, NULLs never collide."""
    rows = df
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose reference names no parent row."""
    known = parent.select(F.col(key).alias(column))
    rows = df.filter(F.col(column).isNotNull())
    return lookup(rows, known, [column], "left_anti").select(*df.columns)


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of NULLs per column, as rows; one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    )
    return counts.select(F.inline(pairs))


def check(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is false; unknown passes, as in a check constraint."""
    return df.filter(~F.coalesce(predicate, F.lit(True)))


def domain(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Rows whose value lies outside the domain."""
    return check(df, F.col(column).isin(list(values)))


def registration_checks(registrations: DataFrame, patients: DataFrame, today: Column) -> DataFrame:
    """Adds `reject_reason`, the first rule a registration breaks, or NULL.

    Input: `phone, email, insurance_prefix, insurance_digits, gender, date_of_birth`.
    """
    known = patients.filter(F.col("insurance_number").isNotNull())
    taken = latest.unique_keys(known, ["insurance_number"]).withColumn("_taken", F.lit(True))

    def matches(column: str, pattern: str) -> Column:
        return F.coalesce(F.col(column).rlike(pattern), F.lit(False))

    # fixed values: the reasons given
    reason = (
        F.when(~matches("phone", text.PHONE), F.lit("Phone must be 10 digits and start with 0"))
        .when(~matches("email", text.EMAIL), F.lit("Invalid email"))
        .when(
            ~matches("insurance_digits", text.INSURANCE_DIGITS),
            F.lit("Insurance number must be 13 digits"),
        )
        .when(F.col("_taken"), F.lit("Insurance already exists"))
        .when(
            ~F.coalesce(F.col("gender").isin(status.GENDERS), F.lit(False)),
            F.lit("Gender must be male or female"),
        )
        .when(
            F.year("date_of_birth") > F.year(today) - 10,
            F.concat(F.lit("DOB must be before "), (F.year(today) - 10).cast("string")),
        )
    )
    full = registrations.withColumn(
        "insurance_number", text.insurance(F.col("insurance_prefix"), F.col("insurance_digits"))
    )
    return (
        lookup(full, taken, ["insurance_number"])
        .withColumn("reject_reason", reason)
        .select(*registrations.columns, "insurance_number", "reject_reason")
    )


def expect_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Fails if a table or view is missing from the catalog."""
    missing = [name for name in names if not spark.catalog.tableExists(name)]
    if missing:
        raise LookupError(f"missing tables: {', '.join(missing)}")
