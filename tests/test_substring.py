import random

import pytest

from slotstream.operators import reads, substring

COLUMNS = ["title", "note"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(7)
    words = ["Ana", "anan", "ñandú", "naNa", "", "a", "50%", "x_y", "Straße", "北京市"]
    data = [(i, " ".join(rng.choices(words, k=rng.randrange(4))), rng.choice(words)) for i in range(300)]
    data += [(300, None, None), (301, "", None), (302, None, "anana"), (302, "again", "anan"), (None, "anan", "anan")]
    return spark.createDataFrame(data, "id long, title string, note string")


@pytest.mark.parametrize(
    "keyword", ["anana", "an", "A", "nan", "0% ", "x_y", "%", "ñ", "straße", "京", "北京市", "nothing here", "anan anan"]
)
def test_same_as_the_scan(table, rows, tmp_path, spark, keyword):
    path = str(tmp_path / "index")
    substring.write(substring.postings(table, "id", COLUMNS), path)
    found = substring.search(table, spark.read.parquet(path), "id", keyword, COLUMNS)
    assert rows(found) == rows(reads.search(table.filter("id IS NOT NULL"), keyword, COLUMNS))


def test_empty_keyword_and_table(table, rows):
    index = substring.postings(table, "id", COLUMNS)
    found = substring.search(table, index, "id", "", COLUMNS)
    assert rows(found) == rows(reads.search(table.filter("id IS NOT NULL"), "", COLUMNS))
    none = table.filter("false")
    assert substring.search(none, substring.postings(none, "id", COLUMNS), "id", "ana", COLUMNS).count() == 0


def test_postings_added_later_and_twice(table, rows, tmp_path, spark):
    path = str(tmp_path / "index")
    old, new = table.filter("id < 150"), table.filter("id >= 150")
    for part in (old, new, new):
        substring.write(substring.postings(part, "id", COLUMNS), path, mode="append")
    found = substring.search(table, spark.read.parquet(path), "id", "anana", COLUMNS)
    assert rows(found) == rows(reads.search(table.filter("id IS NOT NULL"), "anana", COLUMNS))


def test_grams_reach_the_scan(table, tmp_path, spark, capsys):
    path = str(tmp_path / "index")
    substring.write(substring.postings(table, "id", COLUMNS), path)
    for keyword in ("nan", "an"):
        substring.candidates(spark.read.parquet(path), "id", keyword).explain("formatted")
        assert "gram" in capsys.readouterr().out.split("PushedFilters")[1].split("\n")[0]
