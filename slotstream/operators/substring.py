"""Substring search through an index of three-character grams.

At each place of a lower-cased text starts a gram of three characters, or of what is left at the
end. A text that contains a keyword holds all its grams, so keys that do are candidates, and the
texts of the candidates are searched as `reads.search` does. A keyword of one or two characters is
the beginning of a gram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotstream.operators import reads
from slotstream.operators.joins import lookup

WIDTH = 3
# grams of a keyword that are intersected: the rarest ones
RAREST = 4


def postings(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Each gram of each column once per `key`, as `gram`, `field` and the key. NULL and empty
    texts have none."""
    texts = df.select(
        key,
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("field"), F.lower(F.col(c)).alias("text")) for c in columns]
            )
        ),
    ).filter(F.col("text") != "")
    starts = F.sequence(F.lit(1), F.length("text"))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("text"), i, F.lit(WIDTH))))
    return texts.select(F.explode(grams).alias("gram"), "field", key)


def write(index: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """The index as a table sorted by gram, so that a search reads the row groups of its grams.

    Postings of new keys can be appended. A gram that most texts hold spans several files."""
    key = next(c for c in index.columns if c not in ("gram", "field"))
    (
        index.repartitionByRange("gram", key)
        .sortWithinPartitions("gram", key)
        .write.mode(mode)
        .parquet(path)
    )


def candidates(index: DataFrame, key: str, keyword: str) -> DataFrame:
    """Keys of all texts that may contain `keyword`, each once."""
    word = keyword.lower()
    if not word:
        raise ValueError("no gram tells which texts contain the empty keyword")
    if len(word) < WIDTH:
        return index.filter(F.col("gram").startswith(word)).select(key).distinct()
    grams = sorted({word[i : i + WIDTH] for i in range(len(word) - WIDTH + 1)})
    if len(grams) > RAREST:
        counted = index.filter(F.col("gram").isin(grams)).groupBy("gram").count()
        held = {row["gram"]: row["count"] for row in counted.collect()}
        grams = sorted(grams, key=lambda g: (held.get(g, 0), g))[:RAREST]
    return (
        index.filter(F.col("gram").isin(grams))
        .groupBy(key, "field")
        # postings appended twice must not count twice
        .agg(F.count_distinct("gram").alias("n"))
        .filter(F.col("n") == len(grams))
        .select(key)
        .distinct()
    )


def search(df: DataFrame, index: DataFrame, key: str, keyword: str, columns: list[str]) -> DataFrame:
    """The rows of `reads.search(df, keyword, columns)`, found through `index`, the postings of
    `df` by `key`. Rows with a NULL key are in no index and are not found."""
    if not keyword:
        return reads.search(df.filter(F.col(key).isNotNull()), keyword, columns)
    hits = lookup(df, candidates(index, key, keyword), [key], "left_semi")
    return reads.search(hits.select(*df.columns), keyword, columns)
