"""First rows per key without the names of files in every row."""

from slotstream.plans import seed
from slotstream.sources import files


def test_places_are_short_and_keep_their_order(spark, rows):
    data = [("k", "second", "file:/b.csv", 0, 0), ("k", "first", "file:/a.csv", 9, 9), ("k", "third", "file:/b.csv", 0, 1)]
    data += [("other", "x", "file:/b.csv", 0, 2)]
    placed = spark.createDataFrame(data, "slot_id string, note string, _file string, _block long, _line long")
    assert dict(seed._short_lines(placed).dtypes)["_file"] == "int"
    once = seed._without_conflicts(placed, ["slot_id"]).drop(*files.LINE)
    assert rows(once) == [("k", "first"), ("other", "x")]
