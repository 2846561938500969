"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # stream state outgrows the heap long before it outgrows local disks
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # no Python call sites in query plans: noting them costs more than building the plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# application: folders that `materialise` wrote
WRITTEN: dict[str, list[str]] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local-mode session may fall back to a temporary folder: there the driver and the
    executors are one process. Anywhere else, `local-cluster` included, a missing setting is an
    error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="slotstream-")
    context.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` as a table to the shared folder and read it from there.

    All later branches see the very same rows, read only the columns they need, and lost
    executors cost no recomputation beyond this table.
    """
    spark = df.sparkSession
    path = run_dir(spark, "table")
    WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialised(spark: SparkSession) -> int:
    """Deletes what `materialise` wrote in this application, and says how many tables that were.

    Jobs call it when their results are written. Frames that still read the tables fail then.
    """
    paths = WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete(spark, path)
    return len(paths)


def drop_table(table: DataFrame) -> None:
    """Deletes a table that `materialise` wrote; frames that still read it fail then."""
    for folder in {path.rpartition("/")[0] for path in table.inputFiles()}:
        delete(table.sparkSession, folder)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, in whatever file system that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at `path`, in whatever file system that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, not in folders below it; none if there is no such folder."""
    if not exists(spark, path):
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return [f.getPath().getName() for f in files]
