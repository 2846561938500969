"""Message topics as DataFrames: Kafka, or files holding the same columns.

Both give the columns of the Kafka source: `key, value, topic, partition, offset, timestamp`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotstream.sources.registry import NOTIFICATION_SCHEMA

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def _kafka_options(topics: list[str], servers: str, starting: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }


def stream(
    spark: SparkSession,
    topics: str | Iterable[str],
    *,
    fmt: str = "kafka",
    servers: str | None = None,
    path: str | None = None,
    starting: str = "earliest",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A topic, or several, as a stream. `fmt` is `kafka`, or a file format read from `path`."""
    names = [topics] if isinstance(topics, str) else list(topics)
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        if not servers:
            raise ValueError("a Kafka stream needs servers")
        return reader.options(**_kafka_options(names, servers, starting)).load()
    if not path:
        raise ValueError(f"a {fmt} stream needs a path")
    return reader.schema(MESSAGE_SCHEMA).load(path).filter(F.col("topic").isin(names))


def batch(
    spark: SparkSession,
    topics: str | Iterable[str],
    *,
    fmt: str = "kafka",
    servers: str | None = None,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Everything a topic holds, as a batch: the replay of a change log."""
    names = [topics] if isinstance(topics, str) else list(topics)
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        if not servers:
            raise ValueError("a Kafka read needs servers")
        return reader.options(**_kafka_options(names, servers, "earliest")).load()
    if not path:
        raise ValueError(f"a {fmt} read needs a path")
    return reader.schema(MESSAGE_SCHEMA).load(path).filter(F.col("topic").isin(names))


def raw_view(messages: DataFrame) -> DataFrame:
    """Readable columns of raw messages, for inspection of several topics at once."""
    return messages.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.from_json(F.col("value").cast("string"), "map<string,string>").alias("document"),
    )


def notifications(messages: DataFrame) -> DataFrame:
    """Notification events from their topic; messages without a key are dropped."""
    parsed = messages.select(
        F.explode(F.array(F.from_json(F.col("value").cast("string"), NOTIFICATION_SCHEMA))).alias("event")
    )
    return parsed.select("event.*").filter(F.col("notification_key").isNotNull())
