"""A reduced table kept by key, of which a change rewrites only the parts it touches.

Rows belong to one of a fixed number of parts by a hash of their key. A fold takes new rows, reads
the parts these fall into, reduces both together and writes those parts below a folder of its own;
all other parts stay in the files they are in. What makes the fold count is a small table written
last: for every part the fold that wrote it. Readers take the newest finished one, so they see a
fold whole or not at all, and go on reading the files of the one they began with.

    folder/parts/upto=7/part=3/...    written by the fold up to batch 7
    folder/manifest/upto=7/...        (part, upto, parts) of every part after it
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotstream.session import delete, exists, names_in
from slotstream.sinks.writers import UPTO, last_state

PART, PARTS = "_part", 64
MANIFEST = "part int, upto long, parts int"


def part_of(keys: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")


def upto(spark: SparkSession, folder: str) -> int | None:
    """The last batch that the state holds."""
    return last_state(spark, f"{folder}/manifest")


def manifest(spark: SparkSession, folder: str, at: int) -> tuple[dict[int, int], int]:
    """For each part the fold that wrote it, and the number of parts: a row per part at most."""
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest/{UPTO}{at}").collect()
    return {r.part: r.upto for r in rows if r.part >= 0}, max(r.parts for r in rows)


def part_folder(folder: str, fold: int, part: int) -> str:
    return f"{folder}/parts/{UPTO}{fold}/{PART}={part}"


def read(
    spark: SparkSession, folder: str, schema: T.StructType, *, parts: list[int] | None = None, at: int | None = None
) -> DataFrame:
    """The rows of the state, as of the newest fold or the one up to `at`, or of some of its parts;
    none if there is no state yet."""
    at = upto(spark, folder) if at is None else at
    written = manifest(spark, folder, at)[0] if at is not None and at >= 0 else {}
    wanted = [part_folder(folder, written[p], p) for p in sorted(written) if parts is None or p in parts]
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*wanted)


def fold(
    new: DataFrame,
    folder: str,
    keys: list[str],
    reduce: Callable[[DataFrame], DataFrame],
    last: int,
    *,
    parts: int = PARTS,
    base: int | None = None,
) -> list[int]:
    """Takes `new` rows, those of batches up to `last`, into the state; returns the parts rewritten.

    `parts` counts when the state is new. `reduce` keeps rows as they are or drops them, and must
    not mix keys. A fold that did not finish is written again; `base` names the one it goes on from, if
    that is not the newest. Large parts are split into several
    files and rows are sorted by key within them, so lookups skip most of them.
    """
    spark = new.sparkSession
    at = upto(spark, folder) if base is None else base
    written, parts = manifest(spark, folder, at) if at is not None and at >= 0 else ({}, parts)
    touched = touched_parts(new, keys, parts)
    known = read(spark, folder, new.schema, parts=touched, at=at)
    rows = reduce(new.unionByName(known)).select(*new.columns)
    _write(rows, folder, keys, touched, written, parts, last)
    return touched


def touched_parts(rows: DataFrame, keys: list[str], parts: int) -> list[int]:
    """The parts in which the keys of `rows` lie."""
    return sorted(r[0] for r in rows.select(part_of(keys, parts)).distinct().collect())


def change(
    named: DataFrame, folder: str, keys: list[str], schema: T.StructType, apply: Callable[[DataFrame], DataFrame]
) -> list[int]:
    """Rewrites the parts in which the keys `named` lie: `apply` gets their rows and gives those that
    take their place, which must belong to the same parts. Returns the parts."""
    spark = named.sparkSession
    at = upto(spark, folder)
    written, parts = manifest(spark, folder, at)
    touched = touched_parts(named, keys, parts)
    rows = apply(read(spark, folder, schema, parts=touched, at=at)).select(*schema.names)
    _write(rows, folder, keys, touched, written, parts, at + 1)
    return touched


def _write(
    rows: DataFrame, folder: str, keys: list[str], touched: list[int], written: dict[int, int], parts: int, last: int
) -> None:
    """Writes the parts `touched` of the fold `last`, then its manifest."""
    spark = rows.sparkSession
    (
        rows.withColumn(PART, part_of(keys, parts))
        .hint("rebalance", PART)
        .sortWithinPartitions(PART, *keys)
        .write.mode("overwrite")
        .partitionBy(PART)
        .parquet(f"{folder}/parts/{UPTO}{last}")
    )
    found = {
        int(n.removeprefix(f"{PART}="))
        for n in names_in(spark, f"{folder}/parts/{UPTO}{last}")
        if n.startswith(f"{PART}=")
    }
    if found - set(touched):
        raise ValueError(f"rows of parts {sorted(found - set(touched))}, which no key named")
    # a reduction may leave nothing of a part
    written = {p: n for p, n in written.items() if p not in touched} | {p: last for p in found}
    entries = [(p, n, parts) for p, n in sorted(written.items())] or [(-1, last, parts)]
    spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("overwrite").parquet(
        f"{folder}/manifest/{UPTO}{last}"
    )


def expire(spark: SparkSession, folder: str, *, keep: int = 2) -> list[int]:
    """Deletes the folds no part of which the newest `keep` manifests name, and older manifests.
    Readers that began with an older one must have ended."""
    finished = sorted(
        int(n.removeprefix(UPTO))
        for n in names_in(spark, f"{folder}/manifest")
        if exists(spark, f"{folder}/manifest/{n}/_SUCCESS")
    )
    kept = finished[-keep:]
    if not kept:
        return []
    named = {(p, n) for at in kept for p, n in manifest(spark, folder, at)[0].items()}
    gone = []
    for name in names_in(spark, f"{folder}/parts"):
        n = int(name.removeprefix(UPTO))
        if n > kept[-1]:
            continue
        parts = [int(x.removeprefix(f"{PART}=")) for x in names_in(spark, f"{folder}/parts/{name}") if x[0] == "_" and "=" in x]
        for p in parts:
            if (p, n) not in named:
                delete(spark, part_folder(folder, n, p))
        if not any((p, n) in named for p in parts):
            delete(spark, f"{folder}/parts/{name}")
            gone.append(n)
    for n in finished[:-keep]:
        delete(spark, f"{folder}/manifest/{UPTO}{n}")
    return sorted(gone)
