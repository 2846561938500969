"""Benchmark decontamination: documents that hold a benchmark item, up to a few edited words.

Texts are sequences of words: runs of ASCII letters (lower-cased), digits and non-ASCII characters
but for punctuation and blanks. In scripts without blanks between words (Chinese, Japanese, Thai and
others, see UNSPACED) each code point is a word. A document holds an item of n words if some run of its words is at most n/5 word edits (insert,
delete, replace) away.

Embedding. The random walk of Chakraborty, Goldenberg and Koucky reads a sequence with one
pointer: at every step it writes the word under the pointer and moves on if a random bit, which
depends on the step and the word, says so. Equal sequences have equal walks, and after an edit
two walks fall into step again, so few edits leave a small Hamming distance. Items of more than
about PIECE words are cut into pieces of about that size: of the edits of an item, one piece at least
has no more than its share, and a window that agrees with a piece stands for the item around it.
Pieces are grouped by size; windows of that size over the documents are walked like the items, in WALKS
independent walks. Of each walk KEYS random samples of SAMPLES steps are hashed, and windows
that agree with a piece in a sample are candidates. At one fifth of edited words at least 0.98
of the pairs agree somewhere, however long the item; with fewer edits practically all (tests/llm
measures it).

Only windows that can match are walked: k edits spoil at most 3k of a piece's n - 2 word
triples, so a matching run contains n - 2 - 3k triples of benchmark items. This loses nothing.

Every candidate is verified exactly by a bit-parallel edit distance over the region its windows
cover. Items are read in blocks of bounded number, each against all documents.

Defined cases: NULL and empty texts hold nothing. Items of fewer than SHORTEST words are found where
they are all the words of a document, not inside longer texts; NULL items have no words and are not
looked for. Repeated items and repeated documents give a row each. Empty
tables give no rows.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm import words as W
from slotstream.llm.tables import long_array, read, slices, small_batches, text_bytes

WALKS, KEYS, SAMPLES = 8, 8, 3
# items whose tables a task holds at once
BLOCK_ITEMS = 20_000
SHORTEST = 3
# longest item of a group, against the shortest
GROUP = 1.5
# words of the pieces, about, that longer items are looked for by
PIECE = 50

ALNUM = np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
OUTSIDE = ~ALNUM
# fixed values: code points of scripts written without blanks between words
UNSPACED = (
    *((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF)),
    *((0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x312F), (0x31A0, 0x31BF)),
    *((0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA48F), (0xA980, 0xA9FF), (0xAA60, 0xAADF)),
    *((0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x17000, 0x18DFF), (0x1AFF0, 0x1B2FF)),
    (0x20000, 0x3FFFF),
)
MARK, ALONE = 1, 2
KINDS = np.zeros(1 << 21, np.uint8)
for low, high in UNSPACED:
    KINDS[low : high + 1] = ALONE
KINDS[
    [c for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "PZ"]
] = MARK
# all of U+0080 to U+00BF, and U+2000 to U+203F
KINDS[0x80:0xC0] = KINDS[0x2000:0x2040] = MARK


def allowed(n: int) -> int:
    """Word edits up to which a run of words counts as an item of `n` words: a fifth, and so few
    that a word triple is left whole."""
    return min(n // 5, max(0, (n - 3) // 3))


def word_hashes(part: pa.Array):
    raw, offsets = text_bytes(part)
    data = W.LOWER[raw]
    cuts = [offsets]
    # code points by the number of their bytes, with the bits of the first byte
    for low, high, length, bits in ((0xC2, 0xDF, 2, 0x1F), (0xE0, 0xEF, 3, 0x0F), (0xF0, 0xF4, 4, 7)):
        at = np.flatnonzero((raw >= low) & (raw <= high))
        at = at[at + length <= len(raw)]
        point = (raw[at] & bits).astype(np.int32)
        for k in range(1, length):
            point = point << 6 | (raw[at + k] & 0x3F)
        kind = KINDS[point]
        for k in range(length):
            data[at[kind == MARK] + k] = 32
        alone = at[kind == ALONE]
        cuts += [alone, alone + length]
    starts, ends, _ = W.find(data, np.concatenate(cuts), OUTSIDE)
    rows = np.searchsorted(offsets, starts, "right") - 1
    return raw, offsets, starts, ends, rows, W.hashes(data, starts, ends)


def walk(
    hashed: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int, samples: np.ndarray
) -> np.ndarray:
    """For each window from `starts`, cut at `ends`, a hash of the walk at each sample's steps."""
    padded = np.append(hashed, W.U(0))
    keys = np.tile(W.mix(np.arange(len(samples), dtype=W.U) + W.U(seed * 4096)), (len(starts), 1))
    at = starts.copy()
    for step in range(int(samples.max()) + 1):
        if step % 64 == 0:
            salt = W.mix(np.array([seed * 65536 + step + 1], W.U) * W.ODD)[0]
            bits = W.mix(padded ^ salt)
        inside = at < ends
        word = np.where(inside, padded[np.minimum(at, len(hashed))], W.U(0))
        for key in np.flatnonzero((samples == step).any(axis=1)):
            keys[:, key] = W.mix(keys[:, key] * W.ODD + word)
        move = bits[np.minimum(at, len(hashed))] >> W.U(step % 64) & W.U(1)
        at += np.where(inside, move.astype(np.int64), 0)
    return keys


@dataclass
class Group:
    """Pieces of like size, the keys of their walks, and the items they are of, with the words
    before them there."""

    size: int
    longest: int
    hits: int
    samples: list[np.ndarray]
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, W.U))
    items: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    before: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


@dataclass
class Items:
    """A block of benchmark items, ready to be looked for."""

    ids: list
    words: list[np.ndarray]
    triples: np.ndarray
    groups: list[Group]
    # items of fewer than SHORTEST words, by these
    short: dict[tuple, list[int]]

    @classmethod
    def of(cls, ids: list, texts: list[str | None]) -> Items:
        *_, rows, hashed = word_hashes(pa.array(texts, pa.string()))
        cuts = np.searchsorted(rows, np.arange(len(texts) + 1))
        found = [hashed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        short = [i for i, x in enumerate(found) if 0 < len(x) < SHORTEST]
        long = [i for i, x in enumerate(found) if len(x) >= SHORTEST]
        kept = [found[i] for i in long]
        sizes = np.array([len(x) for x in kept], np.int64)
        triples = [W.windows(x, np.zeros(len(x), np.int64), 3)[0] for x in kept]
        out = cls(
            [ids[i] for i in long + short],
            kept + [found[i] for i in short],
            np.unique(np.concatenate([*triples, np.zeros(0, W.U)])),
            [],
            {},
        )
        for number, i in enumerate(short, len(long)):
            out.short.setdefault(tuple(found[i].tolist()), []).append(number)
        flat = np.concatenate([*kept, np.zeros(0, W.U)])
        # pieces: their items, words before them in these, and words
        n_pieces = np.maximum(1, np.round(sizes / PIECE).astype(np.int64))
        owner = np.repeat(np.arange(len(sizes)), n_pieces)
        turn = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        skipped = turn * sizes[owner] // n_pieces[owner]
        begin = (np.cumsum(sizes) - sizes)[owner] + skipped
        sizes = (turn + 1) * sizes[owner] // n_pieces[owner] - skipped
        left = np.argsort(sizes, kind="stable")
        while len(left):
            size = int(sizes[left[0]])
            here = left[sizes[left] < max(size + 1, size * GROUP)]
            left = left[len(here) :]
            edits = np.array([allowed(int(n)) for n in sizes[here]])
            draw = np.random.default_rng(size)
            depth = 2 * size
            samples = [
                np.stack([draw.choice(depth, SAMPLES, replace=False) for _ in range(KEYS)])
                for _ in range(WALKS)
            ]
            group = Group(
                size,
                int((sizes[here] + edits).max()),
                int((sizes[here] - 2 - 3 * edits).min()),
                samples,
            )
            ends = begin[here] + sizes[here]
            keys = np.concatenate(
                [walk(flat, begin[here], ends, s, x).T.ravel() for s, x in enumerate(samples)]
            )
            order = np.argsort(keys, kind="stable")
            piece = np.tile(here, WALKS * KEYS)[order]
            group.keys, group.items, group.before = keys[order], owner[piece], skipped[piece]
            out.groups.append(group)
        return out

    def whole(self, rows: np.ndarray, hashed: np.ndarray) -> Iterator[tuple[int, int]]:
        """First word of the rows that are a short item, and that item."""
        if not self.short or not len(rows):
            return
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        size = np.diff(first, append=len(rows))
        for at, n in zip(first[size < SHORTEST].tolist(), size[size < SHORTEST].tolist(), strict=True):
            for number in self.short.get(tuple(hashed[at : at + n].tolist()), ()):
                yield at, number

    def candidates(self, rows: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where items may begin (a word of the same row) and these items, as a window agrees with
        a piece in a sample; each pair once."""
        none = np.zeros(0, np.int64)
        short = np.array(list(self.whole(rows, hashed)), np.int64).reshape(-1, 2)
        windows, items = self.agreeing(rows, hashed)
        pairs = np.stack(
            [np.concatenate([none, items, short[:, 1]]), np.concatenate([none, windows, short[:, 0]])], 1
        )
        pairs = np.unique(pairs, axis=0)
        return pairs[:, 1], pairs[:, 0]

    def agreeing(self, rows: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`candidates` of SHORTEST words or more, some more than once."""
        none = np.zeros(0, np.int64)
        triples, at = W.windows(hashed, rows, 3)
        if not len(at) or not len(self.triples):
            return none, none
        place = np.minimum(np.searchsorted(self.triples, triples), len(self.triples) - 1)
        hit = np.zeros(len(hashed) + 1, np.int64)
        hit[at[self.triples[place] == triples] + 1] = 1
        before = np.cumsum(hit)
        if not before[-1]:
            return none, none
        # where each word's row ends
        last = np.flatnonzero(np.append(rows[1:] != rows[:-1], True)) + 1
        row_end = np.repeat(last, np.diff(last, prepend=0))
        row_start = np.repeat(np.append(0, last[:-1]), np.diff(last, prepend=0))
        every = np.arange(len(hashed))
        windows, items = [none], [none]
        for group in self.groups:
            # an edit before the item may let its window begin a little early or late
            reach = np.minimum(every + group.longest, row_end)
            starts = np.flatnonzero(before[reach] - before[every] >= group.hits)
            for some in np.array_split(starts, len(starts) // 200_000 + 1):
                for seed, samples in enumerate(group.samples):
                    keys = walk(hashed, some, row_end[some], seed, samples)
                    low = np.searchsorted(group.keys, keys, "left")
                    n = np.searchsorted(group.keys, keys, "right") - low
                    if not n.any():
                        continue
                    where = np.repeat(low.ravel(), n.ravel())
                    run = np.arange(len(where)) - np.repeat(
                        np.cumsum(n.ravel()) - n.ravel(), n.ravel()
                    )
                    items.append(group.items[where + run])
                    window = np.repeat(np.repeat(some, KEYS), n.ravel())
                    windows.append(np.maximum(window - group.before[where + run], row_start[window]))
        return np.concatenate(windows), np.concatenate(items)


def nearest(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Fewest word edits between `item` and a run of `words`, and that run: the first that ends
    earliest. Myers' bit-parallel distance, a bit for each word of the item."""
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)

    def scan(pattern: np.ndarray, text: np.ndarray, anchored: bool) -> list[int]:
        masks: dict[int, int] = {}
        for i, x in enumerate(pattern.tolist()):
            masks[x] = masks.get(x, 0) | 1 << i
        plus, minus, score, out = full, 0, n, []
        for x in text.tolist():
            equal = masks.get(x, 0)
            xv = equal | minus
            xh = ((equal & plus) + plus ^ plus) | equal
            up = minus | ~(xh | plus) & full
            down = plus & xh
            score += bool(up & top) - bool(down & top)
            up = up << 1 | anchored
            down <<= 1
            plus = (down | ~(xv | up)) & full
            minus = up & xv & full
            out.append(score)
        return out

    scores = scan(item, words, False)
    best = min(scores)
    end = scores.index(best) + 1
    back = scan(item[::-1], words[:end][::-1], True)
    return best, end - 1 - back.index(best), end


def matches(part: pa.RecordBatch, items: Items) -> Iterator[tuple[int, int, int, int, int]]:
    """Row, item, edits, and the span in code points of the best place, for a slice."""
    data, offsets, starts, ends, rows, hashed = word_hashes(part.column("text"))
    windows, found = items.candidates(rows, hashed)
    if not len(found):
        return
    points = np.concatenate([[0], np.cumsum(~W.CONTINUES[data])])
    first = np.searchsorted(rows, np.arange(part.num_rows + 1))
    new = np.ones(len(found), bool)
    size = np.array([len(x) for x in items.words])[found]
    new[1:] = (np.diff(found) != 0) | (np.diff(windows) > size[1:])
    new[1:] |= rows[windows[1:]] != rows[windows[:-1]]
    edges = np.append(np.flatnonzero(new), len(found))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for a, b in zip(edges, edges[1:], strict=False):
        number, row = int(found[a]), int(rows[windows[a]])
        item = items.words[number]
        edits = allowed(len(item))
        low = max(int(windows[a]) - 2 * edits - 1, int(first[row]))
        high = min(int(windows[b - 1]) + len(item) + 2 * edits + 1, int(first[row + 1]))
        distance, begin, end = nearest(item, hashed[low:high])
        if distance <= edits:
            place = (distance, low + begin, low + end)
            if place < best.get((row, number), (1 << 62,)):
                best[row, number] = place
    for (row, number), (distance, begin, end) in sorted(best.items()):
        origin = points[offsets[row]]
        yield (
            row,
            number,
            distance,
            int(points[starts[begin]] - origin),
            int(points[ends[end - 1]] - origin),
        )


def blocks(benchmark: DataFrame, most: int = BLOCK_ITEMS) -> Iterator[Items]:
    """The items, in blocks of about `most`."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    n = max(1, -(-rows.count() // most))
    for block in range(n):
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block
        held = rows.filter(own).toArrow() if n > 1 else rows.toArrow()
        yield Items.of(held["item_id"].to_pylist(), held["text"].to_pylist())


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item found in it: `edits` of the best place and where it is."""
    kind = benchmark.schema["item_id"].dataType
    spark = docs.sparkSession
    schema = (
        "doc_id long, item_id string, item_words long, edits long, start_char long, end_char long"
    )

    def search(items: Items) -> DataFrame:
        held = spark.sparkContext.broadcast(items)  # BLOCK_ITEMS at most

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    items = held.value
                    found = np.array(list(matches(part, items)), np.int64).reshape(-1, 5).T
                    ids = part.column("doc_id").cast(pa.int64()).take(long_array(found[0]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids,
                            pa.array([items.ids[i] for i in found[1]], pa.string()),
                            pa.array([len(items.words[i]) for i in found[1]], pa.int64()),
                            *(long_array(x) for x in found[2:]),
                        ],
                        names=[
                            "doc_id",
                            "item_id",
                            "item_words",
                            "edits",
                            "start_char",
                            "end_char",
                        ],
                    )

        return docs.select("doc_id", "text").transform(small_batches).mapInArrow(run, schema)

    out = None
    for items in blocks(benchmark):
        found = search(items)
        out = found if out is None else out.unionByName(found)
    return out.withColumn("item_id", F.col("item_id").cast(kind))


def keep(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no item, with their columns."""
    spark = docs.sparkSession

    def without(rows: DataFrame, items: Items) -> DataFrame:
        held = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    clean = np.ones(part.num_rows, bool)
                    clean[[x[0] for x in matches(part, held.value)]] = False
                    yield part.filter(pa.array(clean))

        return rows.transform(small_batches).mapInArrow(run, docs.schema)

    for items in blocks(benchmark):
        docs = without(docs, items)
    return docs


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
