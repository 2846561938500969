"""Word trigrams with modified Kneser-Ney smoothing, counted and looked up in buckets.

Every word of the corpus goes, with the two words before it, to the bucket of the middle word. There all
that its probability needs meets: the trigram and its context (w1, w2), and the bigram and its context
(w2). Words so frequent that they would fill half a bucket are dealt over all buckets by the word before them, and
their bigrams are added up in a second exchange. The same exchange, by the last word, counts in how
many different words' company a word occurs, and sends each bucket these counts for its words.

Words travel as packed columns, many to a row, coded by a dictionary of the words they are made of: about 7
bytes a word rather than a row of some 30. Buckets are dealt in a fixed number of ranges, one after the other, so
that a part of the words at a time lies in shuffle files.

Words are told apart by 40 bits of their hashes. A bucket holds BUCKET_WORDS words on average, however large
the corpus is; words with one frequent pair before them all lie in the bucket of that pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm import words as W
from slotstream.session import drop_table, materialise

# words of a bucket on average, and bytes of words that a task gathers before it deals them out
BUCKET_WORDS = 1 << 20
GATHERED_BYTES = 48 << 20
# ranges of buckets, dealt one after the other
COUNT_RANGES, SCORE_RANGES = 3, 5
ID_BITS, LANG_BITS = 40, 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# a row has words, or with a part what that part has counted for the bucket, or with TEXTS a block's texts
TOKENS = "bucket int, block long, part int, data binary"
TEXTS = -1
SCORED = "block long, part int, data binary"
COUNTED = "kind int, key long, n long, bucket int, part int, data binary"
# kinds of counts besides 1 to 3, how many grams of that order occur so often: the sum of an order-1
# count, and of heavy words (16 + 4 * half + class) the sum of bigram counts and how many are 1, 2, more
SUM, HEAVY = 0, 16


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the tables written meanwhile go as soon as these are written."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of any lengths as one Arrow row of lists, compressed."""
    lists = [pa.LargeListArray.from_arrays(pa.array([0, len(x)], pa.int64()), pa.array(x)) for x in arrays]
    batch = pa.RecordBatch.from_arrays(lists, names=[str(k) for k in range(len(lists))])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: pa.Scalar) -> list[np.ndarray]:
    batch = pa.ipc.open_stream(data.as_buffer()).read_next_batch()
    return [c.values.to_numpy(zero_copy_only=False) for c in batch.columns]


def ids(hashed: np.ndarray) -> np.ndarray:
    return hashed >> W.U(64 - ID_BITS)


def among(x: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which of `x` are in the sorted `few`."""
    if not len(few):
        return np.zeros(len(x), bool)
    return few[np.minimum(np.searchsorted(few, x), len(few) - 1)] == x


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each different key, in order, one place, and of each place the number of its key."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return W.mix(W.mix(first + W.ODD) + second)


@dataclass(frozen=True)
class Deal:
    """The number of buckets, and the words, sorted, that are dealt over all of them."""

    buckets: int
    heavy: np.ndarray

    def bucket(self, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        at = W.mix(w2 + W.ODD)
        split = among(w2, self.heavy)
        at[split] = pairs(w2[split], w1[split])
        return (at % W.U(self.buckets)).astype(np.int32)

    def part(self, w3: np.ndarray) -> np.ndarray:
        """The part that counts a word; parts are ranges of words."""
        return ((w3 * W.U(self.buckets)) >> W.U(ID_BITS)).astype(np.int32)


@dataclass
class Gathered:
    """Words of one range of buckets that wait to be dealt out."""

    deal: Deal
    held: list[list[np.ndarray]] = field(default_factory=list)
    texts: list[np.ndarray] = field(default_factory=list)
    n_texts: int = 0
    n_bytes: int = 0

    def add(self, columns: list[np.ndarray], texts: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """`bucket`, `w1`, `w2`, `w3`, `half`; for scoring `lang`, `chars` and places among `texts` too."""
        if texts is not None:
            columns[-1] = columns[-1] + np.int32(self.n_texts)
            self.texts.append(texts)
            self.n_texts += len(texts)
        self.held.append(columns)
        self.n_bytes += sum(x.nbytes for x in columns)
        if self.n_bytes >= GATHERED_BYTES:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        columns = [np.concatenate(x) for x in zip(*self.held, strict=True)]
        texts = np.concatenate(self.texts) if self.texts else None
        self.held, self.texts, self.n_texts, self.n_bytes = [], [], 0, 0
        order = np.argsort(columns[0].astype(W.U) << W.U(ID_BITS) | columns[2])
        columns = [x[order] for x in columns]
        bucket = columns[0]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        data = [
            packed_words(*(x[i:j] for x in columns[1:]))
            for i, j in zip(first, [*first[1:], len(bucket)], strict=True)
        ]
        # blocks of the same texts in the same order may be one
        block = 0
        if texts is not None:
            block = int(W.mix(texts.view(W.U) + np.arange(len(texts), dtype=W.U) * W.ODD).sum().view(np.int64))
            data.append(pack(texts))
            first = np.append(first, 0)
        part = [None] * (len(first) - 1) + [None if texts is None else TEXTS]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[first]),
                pa.array([block] * len(first), pa.int64()),
                pa.array(part, pa.int32()),
                pa.array(data, pa.binary()),
            ],
            names=["bucket", "block", "part", "data"],
        )


def packed_words(w1, w2, w3, half, lang=None, chars=None, text=None) -> bytes:
    """Words sorted by `w2`. A word of the dictionary belongs to one language, so that it has one `chars`."""
    new = np.flatnonzero(np.concatenate([[True], w2[1:] != w2[:-1]]))
    runs = np.diff(np.append(new, len(w2))).astype(np.int32)
    key = np.concatenate([w1, w3])
    if lang is not None:
        key = key << W.U(LANG_BITS) | np.tile(lang, 2).astype(W.U)
    coded = pa.array(key).dictionary_encode()
    known, code = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    code1, code3 = code[: len(w1)], code[len(w1) :]
    if lang is None:
        return pack(known, code1, code3, w2[new], runs, half)
    costs = np.zeros(len(known), np.float32)
    costs[code3] = chars
    return pack(known >> W.U(LANG_BITS), code1, code3, w2[new], runs, half, costs, text)


def unpacked_words(data: pa.Scalar) -> list[np.ndarray]:
    """`w1`, `w2`, `w3`, `half`, and for scoring `chars` and the place of the text."""
    known, code1, code3, w2, runs, half, *more = unpack(data)
    columns = [known[code1], np.repeat(w2, runs), known[code3]]
    if not more:
        return [*columns, half]
    costs, text = more
    return [*columns, half, costs[code3], text]


class Grams:
    """The different trigrams, bigrams and last words of a bucket, and their counts outside either half.

    A bigram counts after how many different words it occurs, a word likewise; those of heavy words
    are counted here in part."""

    def __init__(self, deal: Deal, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, half: np.ndarray):
        two = pairs(w2, w3)
        at, self.trigram = grouped(pairs(two, w1))
        later = np.bincount(self.trigram, weights=half)
        self.n3 = np.stack([later, np.bincount(self.trigram) - later]).astype(np.int64)
        self.w1, self.w2 = w1[at], w2[at]
        first, self.bigram = grouped(two[at])
        self.n2 = np.stack([np.bincount(self.bigram, weights=n > 0) for n in self.n3]).astype(np.int64)
        self.first2, self.last2 = self.w2[first], w3[at][first]
        last, self.word = grouped(self.last2)
        self.words = self.last2[last]
        self.is_heavy = among(self.first2, deal.heavy)
        # those of heavy words in the order of parts
        heavy = np.flatnonzero(self.is_heavy)
        self.heavy = heavy[np.argsort(self.last2[heavy], kind="stable")]


def times(n: np.ndarray) -> np.ndarray:
    """How many counts are 0 to 4, and how many are more."""
    return np.bincount(np.minimum(n, 5).astype(np.int64), minlength=6)


def counts(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    kind, key, n = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [])
    none = pa.nulls(len(rows), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array(n, pa.int64()), none, none,
         pa.nulls(len(rows), pa.binary())],
        names=["kind", "key", "n", "bucket", "part", "data"],
    )


def sent(bucket: list[int], part: list[int], data: list[bytes]) -> pa.RecordBatch:
    n = len(data)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
         pa.array(bucket, pa.int32()), pa.array(part, pa.int32()), pa.array(data, pa.binary())],
        names=["kind", "key", "n", "bucket", "part", "data"],
    )


def times_rows(order: int, found: np.ndarray) -> list[tuple[int, int, int]]:
    return [(order, 8 * h + k, int(x)) for h in (0, 1) for k, x in enumerate(times(found[h])) if x]


def count_bucket(deal: Deal) -> Callable[[pa.Table], pa.Table]:
    """Of a bucket's words the counts of counts, and to each part the words and heavy bigrams to be
    added up there."""

    def run(table: pa.Table) -> pa.Table:
        read = [unpacked_words(x) for x in table["data"]]
        g = Grams(deal, *(np.concatenate(x) for x in zip(*read, strict=True)))
        whole = ~g.is_heavy
        rows = times_rows(3, g.n3) + times_rows(2, g.n2[:, whole])
        seen = [np.bincount(g.word, weights=whole & (n > 0)).astype(np.int64) for n in g.n2]
        part, part2 = deal.part(g.words), deal.part(g.last2[g.heavy])
        parts = np.unique(part)
        data = []
        for p in parts:
            here = slice(*np.searchsorted(part, [p, p + 1]))
            at = g.heavy[slice(*np.searchsorted(part2, [p, p + 1]))]
            data.append(pack(g.words[here], *(x[here] for x in seen), g.first2[at], g.last2[at], *(n[at] for n in g.n2)))
        bucket = table["bucket"][0].as_py()
        return pa.Table.from_batches([counts(rows), sent([bucket] * len(parts), parts.tolist(), data)])

    return run


def count_part(table: pa.Table) -> pa.Table:
    """Adds up the words and heavy bigrams of a part, and sends each bucket the sums of its own."""
    table = table.sort_by("bucket")
    read = [unpack(x) for x in table["data"]]
    word, seen0, seen1, first, last, part0, part1 = (np.concatenate(x) for x in zip(*read, strict=True))
    words, of_word = np.unique(word, return_inverse=True)
    at, of_pair = grouped(pairs(first, last))
    n2 = np.stack([np.bincount(of_pair, weights=x, minlength=len(at)) for x in (part0, part1)]).astype(np.int64)
    of_last = np.searchsorted(words, last[at])
    n1 = np.stack(
        [
            np.bincount(of_word, weights=x, minlength=len(words))
            + np.bincount(of_last, weights=n > 0, minlength=len(words))
            for x, n in zip((seen0, seen1), n2, strict=True)
        ]
    ).astype(np.int64)
    rows = times_rows(1, n1) + times_rows(2, n2) + [(SUM, h, int(n1[h].sum())) for h in (0, 1)]
    heavy, of_heavy = np.unique(first[at], return_inverse=True)
    for h in (0, 1):
        for k, x in enumerate((n2[h], n2[h] == 1, n2[h] == 2, n2[h] > 2)):
            total = np.bincount(of_heavy, weights=x, minlength=len(heavy))
            rows += [(HEAVY + 4 * h + k, int(w), int(t)) for w, t in zip(heavy, total, strict=True)]
    ends1, ends2 = (np.cumsum([0, *(len(x[k]) for x in read)]) for k in (0, 3))
    data = []
    for k in range(len(read)):
        mine, pair = of_word[ends1[k] : ends1[k + 1]], of_pair[ends2[k] : ends2[k + 1]]
        data.append(pack(*(n[mine] for n in n1), *(n[pair] for n in n2)))
    return pa.Table.from_batches([counts(rows), sent(table["bucket"].to_pylist(), table["part"].to_pylist(), data)])


@dataclass
class Discounts:
    """What is taken off counts of 0, 1, 2 and more, by order and half; the sums of order 1, and
    of heavy words as first words of bigrams."""

    off: dict[int, list[np.ndarray]]
    total1: list[float]
    off1: list[float]
    heavy: np.ndarray
    total2: list[np.ndarray]
    off2: list[np.ndarray]

    @classmethod
    def of(cls, found: dict[tuple[int, int], int], taken: Callable[[np.ndarray], np.ndarray]) -> Discounts:
        n = {o: [np.array([found.get((o, 8 * h + k), 0) for k in range(6)]) for h in (0, 1)] for o in (1, 2, 3)}
        off = {o: [taken(x) for x in n[o]] for o in n}
        heavy = sorted({key for kind, key in found if kind >= HEAVY})
        of_heavy = [
            [np.array([found.get((HEAVY + 4 * h + k, w), 0) for w in heavy], float) for k in range(4)] for h in (0, 1)
        ]
        return cls(
            off,
            [float(found.get((SUM, h), 0)) for h in (0, 1)],
            [float(off[1][h][1:] @ [*n[1][h][1:3], n[1][h][3:].sum()]) for h in (0, 1)],
            np.array(heavy, W.U),
            [of_heavy[h][0] for h in (0, 1)],
            [sum(off[2][h][k] * of_heavy[h][k] for k in (1, 2, 3)) for h in (0, 1)],
        )


def share(n: np.ndarray, off: np.ndarray, total: np.ndarray, all_off: np.ndarray):
    """Probability by a count, and what its context leaves to the lower order: all if it does not occur."""
    none = total == 0
    safe = np.where(none, 1, total)
    return np.where(none, 0.0, (n - off) / safe), np.where(none, 1.0, all_off / safe)


def shares(g: Grams, contexts: list[np.ndarray], n1: list[np.ndarray], heavy2: list[np.ndarray], d: Discounts, h: int):
    """For texts of half `h`, of each trigram: probability of its last word and what is left to its
    characters, after the words before it and alone. `contexts` numbers those of bigrams and trigrams."""
    context2, context3 = contexts
    off = d.off[1][h][np.minimum(n1[h], 3)]
    p1, left1 = share(n1[h], off, np.full(len(off), d.total1[h]), np.full(len(off), d.off1[h]))
    n2 = g.n2[h].copy()
    n2[g.heavy] = heavy2[h]
    off = d.off[2][h][np.minimum(n2, 3)]
    total, all_off = np.bincount(context2, n2)[context2], np.bincount(context2, off)[context2]
    if len(g.heavy):
        at = np.searchsorted(d.heavy, g.first2[g.heavy])
        total[g.heavy], all_off[g.heavy] = d.total2[h][at], d.off2[h][at]
    p2, left2 = share(n2, off, total, all_off)
    p2, left2 = p2 + left2 * p1[g.word], left2 * left1[g.word]
    off = d.off[3][h][np.minimum(g.n3[h], 3)]
    total, all_off = np.bincount(context3, g.n3[h])[context3], np.bincount(context3, off)[context3]
    p3, left3 = share(g.n3[h], off, total, all_off)
    word = g.word[g.bigram]
    return p3 + left3 * p2[g.bigram], left3 * left2[g.bigram], p1[word], left1[word]


def cost(p: np.ndarray, left: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """The probability of a long word is too small for a number, its logarithm is not."""
    known = p > 0
    return np.where(known, -np.log(np.where(known, p + left * np.exp(-chars), 1)), chars - np.log(left))


def score_bucket(deal: Deal, d: Discounts) -> Callable[[pa.Table], pa.Table]:
    """Of the texts of each row of words the costs of these words, after those before them and alone."""

    def run(table: pa.Table) -> pa.Table:
        mine = table.filter(table["part"].is_null())
        texts = table.filter(pc.equal(table["part"], TEXTS)).select(["block", "part", "data"])
        back = table.filter(pc.greater(table["part"], TEXTS)).sort_by("part")
        read = [unpacked_words(x) for x in mine["data"]]
        w1, w2, w3, half, chars = (np.concatenate(x) for x in zip(*(x[:5] for x in read), strict=True))
        g = Grams(deal, w1, w2, w3, half)
        n10, n11, n20, n21 = (np.concatenate(x) for x in zip(*(unpack(x) for x in back["data"]), strict=True))
        contexts = [grouped(g.first2)[1], grouped(pairs(g.w1, g.w2))[1]]
        costs, alone = np.empty(len(w1)), np.empty(len(w1))
        for h in (0, 1):
            at = np.flatnonzero(half == h)
            found = shares(g, contexts, [n10, n11], [n20, n21], d, h)
            # shares of single precision; their sums are not
            p, left, p_alone, left_alone = (x.astype(np.float32)[g.trigram[at]].astype(float) for x in found)
            costs[at] = cost(p, left, chars[at].astype(float))
            alone[at] = cost(p_alone, left_alone, chars[at].astype(float))
        data, begin = [], 0
        for x in read:
            place = x[5]
            here = slice(begin, begin := begin + len(place))
            n = np.bincount(place)
            sums = [np.bincount(place, y[here])[n > 0] for y in (costs, alone)]
            data.append(pack(np.flatnonzero(n).astype(np.int32), *sums, n[n > 0].astype(np.int32)))
        scored = pa.table({"block": mine["block"], "part": mine["part"], "data": pa.array(data, pa.binary())})
        return pa.concat_tables([scored, texts])

    return run


def sum_block(text: str) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        [texts] = unpack(table.filter(table["part"].is_valid())["data"][0])
        read = [unpack(x) for x in table.filter(table["part"].is_null())["data"]]
        place, *sums = (np.concatenate(x) for x in zip(*read, strict=True))
        costs, alone, n = (np.bincount(place, x, len(texts)) for x in sums)
        here = n > 0
        return pa.table(
            {text: texts[here], "cost": costs[here], "alone": alone[here], "n": n[here].astype(np.int64)}
        )

    return run


def text_costs(
    spark: SparkSession,
    deal: Deal,
    words: Callable[[Deal, int, int, bool], DataFrame],
    taken: Callable[[np.ndarray], np.ndarray],
    text: str,
) -> DataFrame:
    """Of each text the sums of `cost`, `alone` and `n` over its words.

    `words` gives the rows of `Gathered` of a range of buckets, for scoring or not; `taken` the
    discounts from counts of counts."""
    found = []
    with shuffles_dropped(spark):
        for r in range(COUNT_RANGES):
            rows = words(deal, r, COUNT_RANGES, False)
            found.append(materialise(rows.groupBy("bucket").applyInArrow(count_bucket(deal), COUNTED)))
        counted = found[0]
        for more in found[1:]:
            counted = counted.unionByName(more)
        parts = counted.filter("part IS NOT NULL").groupBy("part").applyInArrow(count_part, COUNTED)
        back = materialise(parts)
        numbers = counted.unionByName(back).filter("kind IS NOT NULL").groupBy("kind", "key").agg(F.sum("n"))
        d = Discounts.of({(kind, key): n for kind, key, n in numbers.collect()}, taken)
        for table in found:
            drop_table(table)
        sums = []
        for r in range(SCORE_RANGES):
            known = back.filter(F.col("part").isNotNull() & (F.col("bucket") % SCORE_RANGES == r))
            known = known.select("bucket", F.lit(None).cast("long").alias("block"), "part", "data")
            rows = words(deal, r, SCORE_RANGES, True).unionByName(known)
            scored = rows.groupBy("bucket").applyInArrow(score_bucket(deal, d), SCORED)
            schema = f"{text} long, cost double, alone double, n long"
            sums.append(materialise(scored.groupBy("block").applyInArrow(sum_block(text), schema)))
    out = sums[0]
    for more in sums[1:]:
        out = out.unionByName(more)
    return out.groupBy(text).agg(*[F.sum(c).alias(c) for c in ("cost", "alone", "n")])
