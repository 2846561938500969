"""Where rows go: JDBC tables, batch folders, topics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from slotstream.operators import quality, staging
from slotstream.session import delete, exists, names_in
from slotstream.sources.registry import TableConfig

Metrics = dict[str, int]
BATCH = "dw_batch_id"


def jdbc_append(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, *, batchsize: int = 1000
) -> None:
    """Append to a database table in pages of `batchsize` rows.

    Each partition of `df` uses one connection. Appending nothing writes nothing, so an empty
    batch needs no check that would compute it a second time.
    """
    (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batchsize)
        .options(**(properties or {}))
        .mode("append")
        .save()
    )


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{BATCH}={int(batch_id)}"


def parquet_batch(df: DataFrame, path: str, batch_id: int, *, sort_by: list[str] | None = None) -> str:
    """Write a micro-batch to its own partition folder of a table.

    A repeated batch replaces its folder, so a restart adds no row twice. Sorting by the key
    lets later readers skip row groups.
    """
    folder = batch_folder(path, batch_id)
    rows = df.drop(BATCH)
    if sort_by:
        rows = rows.sortWithinPartitions(*sort_by)
    rows.write.mode("overwrite").parquet(folder)
    return folder


def ensure_table(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """An empty batch below `path`, unless that was done before, so that reads find a table."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(batch_folder(path, -1))


# folder of a state, followed by the last batch it holds
UPTO = "upto="
# states that stay, for those that still read an older one
KEEP_STATES = 3
# batches after which a stream makes a new state of a table that micro-batches look things up in
FOLD_EVERY = 50


def last_state(spark: SparkSession, folder: str) -> int | None:
    """The last batch that the newest finished state below `folder` holds."""
    found = [int(n.removeprefix(UPTO)) for n in names_in(spark, folder) if n.startswith(UPTO)]
    for upto in sorted(found, reverse=True):
        if exists(spark, f"{folder}/{UPTO}{upto}/_SUCCESS"):
            return upto
    return None


def later_folders(spark: SparkSession, path: str, after: int | None, last: int | None) -> list[str]:
    """Finished batch folders of a table, after one batch and up to another."""
    found = [int(n.removeprefix(f"{BATCH}=")) for n in names_in(spark, path) if n.startswith(f"{BATCH}=")]
    wanted = [
        batch_folder(path, n)
        for n in sorted(found)
        if (after is None or n > after) and (last is None or n <= last)
    ]
    return [folder for folder in wanted if exists(spark, f"{folder}/_SUCCESS")]


def finished_batches(spark: SparkSession, path: str, after: int | None) -> list[int]:
    """The batches of a table after one, up to the first that is still being written. Only the
    names of batch folders are listed, not their files."""
    found = [int(n.removeprefix(f"{BATCH}=")) for n in names_in(spark, path) if n.startswith(f"{BATCH}=")]
    out = []
    for batch in sorted(n for n in found if after is None or n > after):
        if not exists(spark, f"{batch_folder(path, batch)}/_SUCCESS"):
            break
        out.append(batch)
    return out


def drop_batches(spark: SparkSession, path: str, upto: int) -> list[int]:
    """Deletes the folders of batches up to `upto`, which a state holds, but for the newest of
    them: a stream that starts again may write that one once more."""
    found = [int(n.removeprefix(f"{BATCH}=")) for n in names_in(spark, path) if n.startswith(f"{BATCH}=")]
    gone = sorted(n for n in found if n <= upto)[:-1]
    for batch in gone:
        delete(spark, batch_folder(path, batch))
    return gone


def state_folder(path: str) -> str:
    return f"{path.rstrip('/')}_state"


def recent(spark: SparkSession, schema: T.StructType, path: str, *, last: int | None = None) -> DataFrame:
    """What a lookup reads of a table: its newest state and the batches after it, up to `last`.

    The folders of earlier batches are neither listed nor read, so a lookup costs the same
    however long the stream has run."""
    upto = last_state(spark, state_folder(path))
    folders = later_folders(spark, path, upto, last)
    if upto is not None:
        folders.append(f"{state_folder(path)}/{UPTO}{upto}")
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def fold(
    spark: SparkSession,
    schema: T.StructType,
    path: str,
    reduce: Callable[[DataFrame], DataFrame],
    batch_id: int,
    *,
    sort_by: list[str],
    every: int = FOLD_EVERY,
) -> int | None:
    """Called at the start of a batch: every so often writes a new state, `reduce` of the last
    state and the batches after it, and returns the batch it holds up to. That is the one before,
    which is committed and will not be repeated. The newest KEEP_STATES states stay for those
    that read them; older ones, and what an unfinished fold left before them, are deleted."""
    upto = last_state(spark, state_folder(path))
    if batch_id - 1 - (-1 if upto is None else upto) < every:
        return None
    rows = reduce(recent(spark, schema, path, last=batch_id - 1))
    target = f"{state_folder(path)}/{UPTO}{batch_id - 1}"
    rows.select(*schema.names).sortWithinPartitions(*sort_by).write.mode("overwrite").parquet(target)
    states = [int(n.removeprefix(UPTO)) for n in names_in(spark, state_folder(path)) if n.startswith(UPTO)]
    for old in sorted(states)[:-KEEP_STATES]:
        delete(spark, f"{state_folder(path)}/{UPTO}{old}")
    return batch_id - 1


def batch_writer(
    cfg: TableConfig,
    write: Callable[[DataFrame, int], None],
    *,
    on_metrics: Callable[[str, int, Metrics], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function: counts the decoded rows, drops those without key, stages and writes.

    The counts are taken while the rows are written, so a batch is computed once.
    """

    def write_batch(decoded: DataFrame, batch_id: int) -> None:
        rows, observation = quality.observed(decoded, cfg.pk, f"{cfg.name}-{batch_id}")
        clean = rows.filter(F.col(cfg.pk).isNotNull())
        write(staging.to_staging(clean, cfg, batch_id=batch_id), batch_id)
        if on_metrics:
            on_metrics(cfg.staging_table, batch_id, dict(observation.get))

    return write_batch


def topic_writer(
    messages: DataFrame,
    topic: str,
    *,
    checkpoint: str,
    fmt: str = "kafka",
    servers: str | None = None,
    path: str | None = None,
) -> DataStreamWriter:
    """A stream of `(key, value)` to a topic, or to files with the topic's columns."""
    writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if fmt == "kafka":
        return (
            writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
        )
    filed = as_messages(messages, topic)
    return filed.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format(
        fmt
    ).option("path", path)


def as_messages(
    messages: DataFrame, topic: str, *, partition: Column | None = None, offset: Column | None = None
) -> DataFrame:
    """`(key, value)` rows with the remaining columns of a topic, for file topics."""
    return messages.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        (F.lit(0) if partition is None else partition).cast("int").alias("partition"),
        (F.lit(None) if offset is None else offset).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
