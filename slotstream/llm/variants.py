"""Spelling variants: words that differ by one code point, over an index of variable-length grams.

Dictionary. A gram of two or three code points is kept as such unless it is frequent among the distinct
words; a frequent one is extended by the code point that follows, up to GRAM_MOST. Only the
frequent grams need to be known, and there are at most 2 * MOST_GRAMS of them whatever the corpus,
as the count from which a gram is frequent grows with the words. They are sent to all executors.

Decomposition. At every place of a word stands the gram that the dictionary leads to. Which gram that
is depends on its own code points alone, so one edit affects only the grams that cover its place. The
bound of a word is the largest number of grams that cover one place; two words within one edit
share all grams of either but so many. Equal grams of one word are numbered.

Lists. A word of g grams and bound b shares at least g - b >= 1 grams with a near word, so its
g - b - 1 longest lists need not be merged: it is entered under its b + 1 rarest grams, and two near
words meet in at least one list. A list is split by length and by an intact half: one edit leaves the
first or the last half of both words as it is. That keeps lists short even for frequent grams.
Members of one list are verified by edit distance.

Defined cases: NULL and empty texts have no words; a NULL `doc_id` reads as no text before the
colon. Repeated rows count as often as they stand there. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm.tables import read
from slotstream.operators.joins import lookup
from slotstream.session import materialise

# Latin letters and the two signs that stand between them
RUN = "([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# the longest gram must be shorter than the shortest word by two, so that every word keeps a gram
GRAM_LEAST, GRAM_MOST = 2, 4
LEAST_LENGTH = GRAM_MOST + 2
# places from which on a gram is frequent, and frequent grams of a length at most
LEAST_FREQUENT, MOST_GRAMS = 100, 100_000
# a form is used so many times as often as its variant
TIMES = 5


def damaged(doc_id: Column, run: Column, every: int) -> Column:
    """`run` without one code point if `every` divides the checksum of `doc_id` and `run`."""
    sum_ = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(sum_, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + F.lit(2), F.length(run)))
    return F.when(sum_ % every == 0, cut).otherwise(run)


def counted(docs: DataFrame, *, least: int = 5, every: int = 199) -> DataFrame:
    """(word, n): the words of at least LEAST_LENGTH code points and `least` occurrences."""
    runs = docs.select(
        "doc_id",
        F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(1))).alias("run"),
    )
    # the shortest that can give a word; damage only shortens
    runs = runs.filter(F.length("run") >= LEAST_LENGTH)
    words = runs.select(damaged(F.col("doc_id"), F.col("run"), every).alias("word"))
    return (
        words.filter(F.length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least)
    )


def frequent_grams(words: DataFrame) -> set[str]:
    """The grams that are extended."""
    places = words.agg(F.coalesce(F.sum(F.length("word") - 1), F.lit(0))).first()[0]
    least = max(LEAST_FREQUENT, places // MOST_GRAMS)
    sizes = F.array(*[F.lit(q) for q in range(GRAM_LEAST, GRAM_MOST)])
    grams = words.select("word", F.explode(sizes).alias("q")).select(
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("word") - F.col("q") + 1),
                lambda p: F.substring("word", p, F.col("q")),
            )
        ).alias("gram")
    )
    rows = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    return set(rows.select("gram").toArrow().column("gram").to_pylist())


def decompose(word: str, frequent: set[str]) -> tuple[list[str], int]:
    """The numbered grams of a word, and how many of them one edit affects at most."""
    grams, cover, seen = [], [0] * len(word), Counter()
    for p in range(len(word) - GRAM_LEAST + 1):
        q = GRAM_LEAST
        while q < GRAM_MOST and p + q < len(word) and word[p : p + q] in frequent:
            q += 1
        gram = word[p : p + q]
        seen[gram] += 1
        grams.append(f"{gram}{seen[gram]}")
        for k in range(p, p + q):
            cover[k] += 1
    return grams, max(cover)


def entries(words: DataFrame, frequent: set[str]) -> DataFrame:
    """(word, gram): every word under its rarest grams, one more than an edit can affect."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("word").to_pylist()
            made = [decompose(w, shared.value) for w in names]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array([g for g, _ in made], pa.list_(pa.string())),
                    pa.array([b for _, b in made], pa.int32()),
                ],
                names=["word", "grams", "bound"],
            )

    grams = materialise(
        words.select("word")
        .mapInArrow(run, "word string, grams array<string>, bound int")
        .select("word", "bound", F.explode("grams").alias("gram"))
    )
    lengths = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("size"))
    rarest = (
        lookup(grams, lengths, ["gram"], "inner")
        .groupBy("word")
        .agg(F.sort_array(F.collect_list(F.struct("size", "gram"))).alias("grams"), F.max("bound").alias("bound"))
    )
    first = F.slice("grams", F.lit(1), F.col("bound") + 1)
    return rarest.select("word", F.explode(F.transform(first, lambda g: g["gram"])).alias("gram"))


def listed(entered: DataFrame, length: Column) -> DataFrame:
    """`entered` with the `list` of its gram, for near words the longer of which has `length` code
    points, one for each half that an edit may leave as it is."""
    half = F.floor(F.col("length") / 2).cast("int")
    return entered.withColumn("length", F.explode(length)).select(
        "word",
        "length",
        F.explode(
            F.array(
                F.xxhash64("gram", "length", F.lit("first"), F.left("word", half)),
                F.xxhash64("gram", "length", F.lit("last"), F.right("word", half)),
            )
        ).alias("list"),
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of words that differ by one inserted, deleted or replaced code point,
    both ways. `words` have at least LEAST_LENGTH code points each."""
    entered = materialise(entries(words, frequent_grams(words)))
    own = F.length("word")
    longer = listed(entered, F.array(own)).toDF("a", "length", "list")
    other = listed(entered, F.array(own, own + 1)).toDF("b", "length", "list")
    ordered = (F.length("b") < F.col("length")) | (F.col("a") < F.col("b"))
    pairs = (
        longer.join(other, ["list", "length"])
        .filter(ordered & (F.levenshtein("a", "b", 1) == 1))
        .select("a", "b")
        .distinct()
    )
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return materialise(pairs.select(F.inline(both)).toDF("word", "near"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root): where the forms (word, form) lead in the end. Each round doubles the steps; a
    step multiplies the count by TIMES at least, so `most`, the largest count, bounds them."""
    steps, reach = 1, TIMES
    while reach < most:
        steps, reach = steps + 1, reach * TIMES
    way, done = materialise(forms.toDF("word", "root")), 1
    while done < steps:
        on = way.toDF("root", "further")
        way = materialise(
            lookup(way, on, ["root"]).select("word", F.coalesce("further", "root").alias("root"))
        )
        done *= 2
    return way


def variants(words: DataFrame) -> DataFrame:
    """Of every word of (word, n) its form, the near word of largest n if that is TIMES its own; its
    root, to which forms lead; its number of near words and the count of its form."""
    words = materialise(words)
    pairs = lookup(near_words(words), words.toDF("near", "near_n"), ["near"], "inner")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
    about = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = lookup(words, about, ["word"])
    enough = -F.col("best.minus") >= TIMES * F.col("n")
    known = materialise(
        known.select(
            "word",
            F.when(enough, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, -F.col("best.minus")).alias("form_n"),
        )
    )
    most = known.agg(F.max("n")).first()[0] or 0
    way = roots(known.filter("form IS NOT NULL").select("word", "form"), most)
    return lookup(known, way, ["word"]).select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(counted(read(spark, sf_dir, "documents")))


# checksums by a table of 256 steps over the bytes; near words by what is left when one code point goes
OP12_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) AS t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8
), runs AS (
  SELECT doc_id, run, count(*) AS n, hex(encode(concat(doc_id, ':', run))) AS x FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2),
      lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]))) AS h
  FROM runs, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
      ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM words, range(1, length(word) + 1) AS r(i)
  UNION ALL SELECT word, n, 0, word FROM words
), pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut
  WHERE a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)
), about AS (
  SELECT word, n, count(*) AS n_near, min(struct_pack(minus := -near_n, near := near)) AS best
  FROM pairs GROUP BY word, n
), known AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best.minus >= 5 * w.n THEN best.near END AS form,
    CASE WHEN -best.minus >= 5 * w.n THEN -best.minus END AS form_n
  FROM words w LEFT JOIN about USING (word)
), way AS (
  SELECT word, word AS at FROM known
  UNION ALL SELECT way.word, form FROM way JOIN known ON known.word = way.at WHERE form IS NOT NULL
)
SELECT k.word, k.form, way.at AS root, k.n, k.n_near::BIGINT AS n_near, k.form_n::BIGINT AS form_n
FROM known k JOIN way ON way.word = k.word JOIN known last ON last.word = way.at AND last.form IS NULL
"""
