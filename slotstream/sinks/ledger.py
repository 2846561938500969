"""Batches to a database table, each counted once however often it is repeated.

A ledger table names, for every target, the finished batches. A batch that stands there is passed
over. Any other is fenced: rows that an earlier, broken attempt left are removed first, then the
batch is appended under an attempt number of its own, then the ledger gets its row. A straggling
task of an earlier attempt may still append rows after that; they carry another attempt number, and
`counted` leaves them out, as it does the rows of unfinished batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.operators.joins import lookup
from slotstream.sinks import writers

LEDGER = "dw_batches"
ATTEMPT = "dw_attempt"
# statements with ? for each parameter; rows come back for a query
Execute = Callable[[str, list[object]], list[tuple]]


def connection(spark: SparkSession, url: str, properties: dict[str, str] | None = None) -> Execute:
    """Statements on a connection of the driver's, opened for each and closed after it.

    As for Spark's own JDBC writer, the property `driver` names a driver class that came with --jars."""
    settings = spark._jvm.java.util.Properties()
    for name, value in (properties or {}).items():
        settings.setProperty(name, value)
    if driver := (properties or {}).get("driver"):
        spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)

    def execute(statement: str, values: list[object]) -> list[tuple]:
        opened = spark._jvm.java.sql.DriverManager.getConnection(url, settings)
        try:
            prepared = opened.prepareStatement(statement)
            for place, value in enumerate(values, 1):
                prepared.setObject(place, value)
            if not prepared.execute():
                return []
            found, rows = prepared.getResultSet(), []
            width = found.getMetaData().getColumnCount()
            while found.next():
                rows.append(tuple(found.getObject(i) for i in range(1, width + 1)))
            return rows
        finally:
            opened.close()

    return execute


def append_once(
    df: DataFrame,
    execute: Execute,
    append: Callable[[DataFrame, str], None],
    table: str,
    batch_id: int,
) -> bool:
    """Appends batch `batch_id` to `table`, unless the ledger has it; says whether it did.

    `table` has the columns `dw_batch_id` and `dw_attempt`; the ledger has target, batch and attempt,
    the first two of them its primary key, so that of two jobs only one can finish a batch."""
    done = execute(f"SELECT attempt FROM {LEDGER} WHERE target = ? AND batch_id = ?", [table, batch_id])
    if done:
        return False
    attempt = uuid.uuid4().hex
    execute(f"DELETE FROM {table} WHERE {writers.BATCH} = ?", [batch_id])
    append(df.withColumns({writers.BATCH: F.lit(batch_id), ATTEMPT: F.lit(attempt)}), table)
    execute(
        f"INSERT INTO {LEDGER} (target, batch_id, attempt) VALUES (?, ?, ?)", [table, batch_id, attempt]
    )
    return True


def counted(rows: DataFrame, ledger: DataFrame, table: str) -> DataFrame:
    """The rows of `table` that belong to finished batches, by the attempt that finished them."""
    finished = ledger.filter(F.col("target") == table).select(
        F.col("batch_id").alias(writers.BATCH), F.col("attempt").alias(ATTEMPT)
    )
    return lookup(rows, finished, [writers.BATCH, ATTEMPT], "left_semi").select(*rows.columns)
