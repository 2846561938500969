"""Change topics to staging tables, and on to dimensions and facts, as streams."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from slotstream.operators import cdc, latest, warehouse
from slotstream.operators.joins import lookup
from slotstream.session import build_session, shared_dir
from slotstream.sinks import ledger, writers
from slotstream.sources import topics
from slotstream.sources.registry import DEFAULT_TOPIC_PREFIX, TABLES, TableConfig
from slotstream.streaming import progress

DIMENSIONS: dict[str, dict[str, Callable[[DataFrame], DataFrame]]] = {
    "doctor": {"dim_doctor": warehouse.dim_doctor},
    "patient": {"dim_patient": warehouse.dim_patient},
    "slot_code_template": {"dim_slot_code": warehouse.dim_slot_code},
    "doctor_slot": {
        "dim_doctor_slot": warehouse.dim_doctor_slot,
        "fact_slot_daily": warehouse.fact_slot_daily,
    },
}
SLOT_FACTS: dict[str, tuple[str, Callable[[DataFrame, DataFrame], DataFrame]]] = {
    "appointment": ("fact_appointment", warehouse.fact_appointment),
    "appointment_transaction": ("fact_appointment_transaction", warehouse.fact_transaction),
    "medical_record": ("fact_medical_record", warehouse.fact_record),
}

# the columns of staged slots that facts need
SLOT_VERSIONS = T.StructType(
    [
        T.StructField("slot_id", T.StringType()),
        T.StructField("doctor_id", T.StringType()),
        T.StructField("slot_date", T.DateType()),
        T.StructField("slot_code", T.StringType()),
        T.StructField("is_deleted", T.IntegerType()),
        T.StructField("cdc_ts", T.TimestampType()),
        T.StructField("source_partition", T.IntegerType()),
        T.StructField("source_offset", T.LongType()),
    ]
)


def slot_path(root: str) -> str:
    return f"{root}/{TABLES['doctor_slot'].staging_table}"


def _known_versions(slots: DataFrame) -> DataFrame:
    """The versions from which `warehouse.slot_attributes` takes what is known of each slot."""
    known = slots.filter(F.col("is_deleted") == 0)
    return latest.replace_latest(known, ["slot_id"], warehouse.STAGING_ORDER)


def slots_of(rows: DataFrame, root: str) -> DataFrame:
    """Attributes of the slots that `rows` name, from what staging holds by now."""
    # Slot ids start with their date and files are sorted by them, so the range of the batch
    # keeps most of the state from being read.
    low, high = rows.agg(F.min("slot_id"), F.max("slot_id")).first()
    known = writers.recent(rows.sparkSession, SLOT_VERSIONS, slot_path(root))
    near = known.filter(F.col("slot_id").between(F.lit(low), F.lit(high)))
    named = lookup(near, latest.unique_keys(rows, ["slot_id"]), ["slot_id"], "left_semi")
    return warehouse.slot_attributes(named)


def stage_and_build(
    cfg: TableConfig, root: str, *, fold_every: int = writers.FOLD_EVERY
) -> Callable[[DataFrame, int], None]:
    """Write a staging batch, then the dimension and fact rows that follow from it.

    The later tables are derived from the folder just written, so the source batch is
    decoded once however many tables hang on it. The slot stream makes a new state of known
    slots every `fold_every` batches, from which facts look them up.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        if cfg.name == "doctor_slot":
            writers.fold(
                rows.sparkSession,
                SLOT_VERSIONS,
                slot_path(root),
                _known_versions,
                batch_id,
                sort_by=[cfg.pk],
                every=fold_every,
            )
        folder = writers.parquet_batch(rows, f"{root}/{cfg.staging_table}", batch_id, sort_by=[cfg.pk])
        stored = rows.sparkSession.read.schema(rows.drop(writers.BATCH).schema).parquet(folder)
        for name, derive in DIMENSIONS.get(cfg.name, {}).items():
            writers.parquet_batch(derive(stored), f"{root}/{name}", batch_id)
        if cfg.name in SLOT_FACTS:
            name, derive = SLOT_FACTS[cfg.name]
            facts = derive(stored, slots_of(stored, root))
            writers.parquet_batch(facts, f"{root}/{name}", batch_id)

    return write


def stage_only(cfg: TableConfig, root: str) -> Callable[[DataFrame, int], None]:
    """Write a staging batch."""

    def write(rows: DataFrame, batch_id: int) -> None:
        writers.parquet_batch(rows, f"{root}/{cfg.staging_table}", batch_id, sort_by=[cfg.pk])

    return write


def stage_to_jdbc(
    cfg: TableConfig,
    url: str,
    properties: dict[str, str] | None = None,
    *,
    batchsize: int = 1000,
    execute: ledger.Execute | None = None,
) -> Callable[[DataFrame, int], None]:
    """Append a staging batch to a database table.

    Without `execute` a repeated batch is appended again; its number is a column, by which a reader
    can tell repeated batches apart. With it (`ledger.connection`) a ledger keeps batches from being
    repeated.
    """

    def append(rows: DataFrame, table: str) -> None:
        writers.jdbc_append(rows, url, table, properties, batchsize=batchsize)

    def write(rows: DataFrame, batch_id: int) -> None:
        staged = rows.drop("source_partition", "source_offset")
        if execute:
            ledger.append_once(staged, execute, append, cfg.staging_table, batch_id)
        else:
            append(staged, cfg.staging_table)

    return write


def table_stream(
    messages: DataFrame,
    cfg: TableConfig,
    write: Callable[[DataFrame, int], None],
    checkpoint_root: str,
    *,
    ingested_at: Column | None = None,
    on_metrics: Callable[[str, int, writers.Metrics], None] | None = None,
) -> DataStreamWriter:
    """The stream of one table: decode, then one `foreachBatch` per micro-batch."""
    decoded = cdc.decode(messages, cfg, ingested_at=ingested_at, keep_null_keys=True)
    return (
        decoded.writeStream.outputMode("append")
        .queryName(cfg.staging_table)
        .option("checkpointLocation", cfg.checkpoint(checkpoint_root))
        .foreachBatch(writers.batch_writer(cfg, write, on_metrics=on_metrics))
    )


def rejected_stream(
    messages: DataFrame, cfg: TableConfig, path: str, checkpoint_root: str
) -> DataStreamWriter:
    """The messages `table_stream` cannot use, with the reason, to a table of their own."""
    return (
        progress.counting_rejects(cdc.rejected(messages, cfg))
        .writeStream.outputMode("append")
        .queryName(f"rejected_{cfg.name}")
        .option("checkpointLocation", f"{cfg.checkpoint(checkpoint_root)}_rejected")
        .format("parquet")
        .option("path", path)
    )


def streams_beside(rejects: str) -> list[str]:
    """The stream of rows that reads the messages of this stream of rejects."""
    return [cfg.staging_table for cfg in TABLES.values() if rejects == f"rejected_{cfg.name}"]


def run_all(
    streams: Iterable[DataStreamWriter],
    *,
    once: bool = False,
    after: Iterable[DataStreamWriter] = (),
) -> list[StreamingQuery]:
    """Start all streams and wait. With `once` each handles what is there and ends, and those in
    `after` start when the others have ended.

    Without it the call returns, with the error, when any of them ends.
    """
    queries = []
    for group in (streams, after):
        queries += [x.trigger(availableNow=True).start() if once else x.start() for x in group]
        if once:
            for query in queries:
                query.awaitTermination()
    if queries and not once:
        queries[0].sparkSession.streams.awaitAnyTermination()
    return queries


def main() -> None:
    """Fourteen streams: rows and rejected messages of each captured table.

    With --once slots go first, so that facts find them. Otherwise facts may be ahead of their
    slots; `plans.warehouse.current_views` looks slots up again when it is given them.
    """
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--servers", required=True)
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--root", help="folder of the warehouse tables")
    target.add_argument("--jdbc-url", help="database of the staging tables")
    parser.add_argument("--ledger", action="store_true", help="count repeated batches to the database once")
    parser.add_argument("--progress", help="folder of a table with a row per batch")
    parser.add_argument("--reject-limit", type=float, help="share of rejects that stops a table's streams")
    parser.add_argument("--rejects", help="folder of the rejected messages; default: ROOT/rejected")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--topic-prefix", default=DEFAULT_TOPIC_PREFIX)
    parser.add_argument("--once", action="store_true")
    parser.add_argument("--max-offsets", help="messages per micro-batch and table")
    parser.add_argument("--min-partitions", help="read tasks per table, to split large topic partitions")
    args = parser.parse_args()
    if args.reject_limit is not None and not args.progress:
        parser.error("--reject-limit needs --progress")
    if not (args.rejects or args.root):
        parser.error("--rejects is needed with --jdbc-url")
    rejects = (args.rejects or f"{args.root}/rejected").rstrip("/")
    spark = build_session("change-staging")
    checkpoints = f"{shared_dir(spark)}/streams"
    limits = {"maxOffsetsPerTrigger": args.max_offsets, "minPartitions": args.min_partitions}
    options = {name: value for name, value in limits.items() if value}
    properties = dict(pair.split("=", 1) for pair in args.jdbc_option)

    def target_of(cfg: TableConfig) -> Callable[[DataFrame, int], None]:
        if args.root:
            return stage_and_build(cfg, args.root)
        execute = ledger.connection(spark, args.jdbc_url, properties) if args.ledger else None
        return stage_to_jdbc(cfg, args.jdbc_url, properties, execute=execute)

    def source(cfg: TableConfig) -> DataFrame:
        topic = cfg.topic(args.topic_prefix)
        return topics.stream(spark, topic, servers=args.servers, options=options)

    def rows(cfg: TableConfig) -> DataStreamWriter:
        return table_stream(
            source(cfg),
            cfg,
            target_of(cfg),
            checkpoints,
            on_metrics=lambda table, batch, counts: print(f"{table} batch {batch}: {counts}"),
        )

    rejected = [
        rejected_stream(source(cfg), cfg, f"{rejects}/{cfg.name}", checkpoints)
        for cfg in TABLES.values()
    ]
    log = progress.BatchLog(spark, args.progress, limit=args.reject_limit, beside=streams_beside)
    with log if args.progress else nullcontext():
        run_all(
            [rows(cfg) for cfg in TABLES.values() if cfg.name not in SLOT_FACTS] + rejected,
            once=args.once,
            after=[rows(cfg) for cfg in TABLES.values() if cfg.name in SLOT_FACTS],
        )


if __name__ == "__main__":
    main()
