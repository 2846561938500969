"""Facts follow their slots: a delta join that appends corrected versions.

A fact is written with what is known of its slot at that time. A slot that arrives or changes later
makes the facts that name it wrong. Each run joins what is new on either side with what the other
side holds: new facts with all known slots, and known facts with the slots changed since the last
run. Versions whose slot columns come out different are appended as corrections, which readers take
in place of the version they correct; a later version of the fact still wins over them.

Known facts are kept by slot (`sinks.keyed`), so a run reads only the parts in which changed slots
lie, and the slots of what it looks up. It can run beside the streams: it takes finished batches, and
what it misses is new to the next run. A run that fails is done again under its number.

    root/fact_x_corrections/dw_batch_id=3/   corrections of run 3
    root/fact_x_by_slot/                     the latest version of every fact and slot
    root/fact_x_follow/upto=3/               the fact and slot batches that run 3 has taken in
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.operators import latest, warehouse
from slotstream.operators.joins import lookup
from slotstream.operators.warehouse import CORRECTION
from slotstream.plans.warehouse import SLOT_FACTS
from slotstream.session import build_session, materialise
from slotstream.sinks import keyed, writers
from slotstream.streaming import staging

SLOT_COLUMNS = ["doctor_id", "slot_date", "slot_code"]
MARKS = "fact_batch long, slot_batch long"


def corrections_path(root: str, fact: str) -> str:
    return f"{root.rstrip('/')}/{fact}_corrections"


def _read(spark: SparkSession, path: str, batches: list[int]) -> DataFrame:
    return spark.read.parquet(*[writers.batch_folder(path, n) for n in batches])


def follow(
    spark: SparkSession, root: str, fact: str, *, parts: int = keyed.PARTS, missing: str | None = ""
) -> int | None:
    """One run for the table `fact`; returns its number, or nothing if there was nothing new."""
    root = root.rstrip("/")
    marks, by_slot = f"{root}/{fact}_follow", f"{root}/{fact}_by_slot"
    done = writers.last_state(spark, marks)
    run = 0 if done is None else done + 1
    seen = (None, None)
    if done is not None:
        seen = tuple(spark.read.schema(MARKS).parquet(f"{marks}/{writers.UPTO}{done}").first())
    facts = writers.finished_batches(spark, f"{root}/{fact}", seen[0])
    slots = writers.finished_batches(spark, staging.slot_path(root), seen[1])
    if not facts and (not slots or seen[0] is None):
        return None
    key, _ = warehouse.CURRENT_KEYS[fact]
    sample = facts or writers.finished_batches(spark, f"{root}/{fact}", None)
    number = F.lit(0).cast("long")
    schema = _read(spark, f"{root}/{fact}", sample[-1:]).withColumn(CORRECTION, number).schema
    touched = spark.createDataFrame([], schema)
    if facts:
        touched = _read(spark, f"{root}/{fact}", facts).withColumn(CORRECTION, number)
    if slots and run:
        changed = _read(spark, staging.slot_path(root), slots).select("slot_id").distinct()
        held = keyed.manifest(spark, by_slot, run - 1)[1]
        wanted = [r[0] for r in changed.select(keyed.part_of(["slot_id"], held)).distinct().collect()]
        known = keyed.read(spark, by_slot, schema, parts=wanted, at=run - 1)
        touched = touched.unionByName(lookup(known, changed, ["slot_id"], "left_semi"))
    order = [*warehouse.ORDER, CORRECTION]
    newest = materialise(latest.replace_latest(touched, [key, "slot_id"], order))
    was = newest.withColumn("_was", F.struct(*SLOT_COLUMNS))
    fresh = warehouse.refresh_slot_columns(was, staging.slots_of(newest, root), missing=missing)
    wrong = F.lit(False)
    for c in SLOT_COLUMNS:
        wrong = wrong | ~F.col(f"_was.{c}").eqNullSafe(F.col(c))
    rows = fresh.withColumn("_wrong", wrong).drop("_was")
    rows = materialise(
        rows.withColumn(CORRECTION, F.when(F.col("_wrong"), F.lit(run + 1).cast("long")).otherwise(F.col(CORRECTION)))
    )
    writers.parquet_batch(rows.filter("_wrong").select(*schema.names), corrections_path(root, fact), run)
    keyed.fold(
        rows.select(*schema.names),
        by_slot,
        ["slot_id"],
        lambda df: latest.replace_latest(df, [key, "slot_id"], order),
        run,
        parts=parts,
        base=run - 1,
    )
    upto = tuple(new[-1] if new else old for new, old in ((facts, seen[0]), (slots, seen[1])))
    spark.createDataFrame([upto], MARKS).write.mode("overwrite").parquet(f"{marks}/{writers.UPTO}{run}")
    keyed.expire(spark, by_slot)
    return run


def with_corrections(spark: SparkSession, versions: DataFrame, root: str, fact: str) -> DataFrame:
    """The versions of a fact with their corrections; current views take these into account."""
    path = corrections_path(root, fact)
    finished = writers.finished_batches(spark, path, None)
    if CORRECTION not in versions.columns:
        versions = versions.withColumn(CORRECTION, F.lit(0).cast("long"))
    return versions.unionByName(_read(spark, path, finished)) if finished else versions


def main() -> None:
    """Append corrected versions of all facts whose slots arrived or changed since the last run."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--root", required=True, help="folder of the warehouse tables")
    args = parser.parse_args()
    spark = build_session("facts-follow-slots")
    for fact in SLOT_FACTS:
        print(f"{fact}: run {follow(spark, args.root, fact)}")


if __name__ == "__main__":
    main()
