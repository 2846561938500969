"""Topics of the stream queries: written by many tasks, read in as many micro-batches as asked for."""

import pytest
from pyspark.sql import functions as F

from slotstream.checks import streams
from slotstream.session import names_in


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_many_files_a_batch(spark, tmp_path, batches):
    rows = spark.range(2000).select(
        F.col("id").cast("string").alias("key"),
        F.lit("v").alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    path = f"{tmp_path}/topic"
    streams.topic_files(rows, path, batches)
    files = [x for x in names_in(spark, path) if x.endswith(".parquet")]
    assert len(files) == batches * spark.sparkContext.defaultParallelism
    seen = []
    query = streams.file_stream(spark, "t", path, batches).writeStream.foreachBatch(
        lambda df, n: seen.append(df.count())
    )
    query.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == batches and sum(seen) == 2000 and min(seen) > 0


def test_few_messages(spark, tmp_path):
    rows = spark.createDataFrame([("a", "v", "t", 0, 1, None)], streams.topics.MESSAGE_SCHEMA)
    streams.topic_files(rows, f"{tmp_path}/topic", 4)
    got = []
    query = streams.file_stream(spark, "t", f"{tmp_path}/topic", 4).writeStream.foreachBatch(
        lambda df, n: got.extend(df.collect())
    )
    query.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert [r.key for r in got] == ["a"]
