"""Physical plans of the registered queries: what must never appear in them."""

import datetime as dt
import re

import pytest

import __spark_entry__ as entry_file
from slotstream.checks import QUERIES
from slotstream.operators import latest, mutations
from slotstream.testdata import view

SF = "/root/testdata/sf0.001"
# these start a job of their own while they are built; what they return is a read of its result
EAGER = ("stream_", "csv_", "seed_")
BATCH = [n for n in QUERIES if not n.startswith(EAGER)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As at scale: no table is small enough to be broadcast unasked."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# broadcasts the code asks for: holidays, whose number it checks, and the shifts of numbered partitions
HINTED = {
    "schedule_generate", "schedule_auto", "schedule_auto_locks", "sequence_ids", "append_versions",
    "slot_update_verdicts", "records_by_slot", "records_by_insurance", "patient_appointments",
    "doctor_appointments", "insurance_numbers", "ordered_records",
}


@pytest.mark.parametrize("name", BATCH)
def test_plan(spark, no_broadcast, name):
    text = plan_of(entry_file.queries()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "InPandas"):
        assert node not in text
    if not name.startswith("booking_admit_") and not name.startswith("booking_cancel_") and name not in HINTED:
        assert "BroadcastHashJoin" not in text


def test_scan_reads_only_what_is_needed(spark):
    text = plan_of(entry_file.queries()["doctor_appointments"](spark, SF))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert read and all("o_totalprice" not in columns for columns in read)


def test_filters_reach_the_scan(spark):
    text = plan_of(entry_file.queries()["rebuild_appointments"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1
    appointments = plan_of(view(spark, SF, "v_appointment"))
    assert "EqualTo(o_orderstatus,F)" in appointments


def test_latest_combines_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 AS k", "id AS v")
    text = plan_of(latest.replace_latest(df, ["k"], ["v"]))
    assert text.index("max_by") < text.index("Exchange") < text.index("partial_max_by")


def test_first_of_a_batch_combines_before_the_shuffle(spark, no_broadcast):
    df = spark.range(10).selectExpr("id % 3 AS k", "id AS v")
    text = plan_of(mutations.accepted_inserts(df, df, ["k"], ["v"]))
    assert "partial_min_by" in text and "LeftAnti" in text


def test_the_monthly_job_reads_two_months(spark, tmp_path):
    from slotstream.plans import monthly, seed
    from slotstream.sources.tables import table

    source = str(tmp_path / "source")
    slots = view(spark, SF, "v_slot_month").unionByName(
        view(spark, SF, "v_slot").select(*view(spark, SF, "v_slot_month").columns)
    )
    tables = {
        "doctor": view(spark, SF, "v_doctor"),
        "doctor_slot": slots,
        "doctor_insert_month": QUERIES["month_locks"](spark, SF),
        "calendar_day": monthly.schedule.calendar_days(spark),
    }
    seed.write(tables, source)
    today, target = dt.date(2026, 4, 30), str(tmp_path / "target")
    plan = plan_of(monthly.month_slots(table(spark, "doctor_slot", root=source), today))
    assert re.search(r"PartitionFilters: \[[^]]*slot_month", plan)
    folder = monthly.run(spark, source, target, today)
    first = sorted(map(tuple, spark.read.parquet(folder).collect()))
    # as after a stop between the two writes
    locks = tmp_path / "target" / "doctor_insert_month"
    locks.rename(tmp_path / "locks")
    assert sorted(map(tuple, spark.read.parquet(monthly.run(spark, source, target, today)).collect())) == first
    with pytest.raises(ValueError, match="the month is done"):
        monthly.run(spark, source, target, today)
    assert first and folder.endswith("slot_month=2026-05")
