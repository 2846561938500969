"""The shared folder and what is kept in it."""

import os

import pytest
from pyspark.sql import functions as F

from slotstream import session
from slotstream.operators import reads


def test_materialised_tables_are_dropped(spark):
    df = session.materialise(spark.range(5))
    (folder,) = {os.path.dirname(p.removeprefix("file:")) for p in df.inputFiles()}
    assert os.path.isdir(folder) and session.exists(spark, folder)
    assert session.drop_materialised(spark) >= 1
    assert not os.path.exists(folder) and session.drop_materialised(spark) == 0


class Cluster:
    """A session without a named folder on a given master."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master = master

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return None


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
def test_only_local_mode_may_do_without_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster(master))


def test_pages_after_a_row(spark):
    df = spark.range(20).select((F.col("id") % 4).alias("a"), "id").repartition(3)
    pages, last = [], None
    while page := [tuple(r) for r in reads.page_after(df, ["a", "id"], last, 6).collect()]:
        pages += page
        last = page[-1]
    assert pages == sorted((i % 4, i) for i in range(20))
