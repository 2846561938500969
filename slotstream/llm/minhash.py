"""Near-duplicate documents: fast similarity sketches, banding and exact verification.

Sketch. A set of shingles fills `SIZE` coordinates. In round i each shingle is hashed to one
coordinate with a value that is larger than all of earlier rounds, and a coordinate keeps
the smallest it gets. After `SIZE` rounds, round SIZE + j puts every shingle into coordinate j,
so each coordinate fills, mostly in the first two rounds. Two sketches agree in a coordinate with
the probability of their sets' Jaccard similarity, with the concentration of independent draws.

Bands of four coordinates are hashed. At similarity 0.8 two texts miss all 32 bands with
probability (1 - 0.8^4)^32 < 10^-7. Copies (equal word sequences) are one node from the start.

Links. Comparing all members of a bucket would cost the square of its size. In each bucket the
member that meets most others (over all its buckets) is the hub, and only the others' pairs with
the hub are verified, on the full shingle sets. Components of the confirmed links follow. Two
documents that share a bucket share its hub, so links that are still missing lie between followers
of one hub in different components. Most such hubs have followers that met it by chance: their
sketches, a byte for each coordinate, are compared, and followers stay only if one in another
component agrees with them in LEAST_MARKS coordinates or more (at similarity 0.8 missed with
probability < 10^-8). Those are compared exactly, by counting common shingles over
inverted lists. Both comparisons work in cells of bounded size, into which a hub's followers are
dealt block by block, and give back followers and links, not pairs: no more than one link for each
follower and component.

Defined cases: NULL and empty texts have empty sets and are linked with nothing. Rows with one
`doc_id` are one document; a NULL `doc_id` is linked with nothing, has a NULL component, and is
kept. Repeated rows give a row each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm import words as W
from slotstream.llm.graph import components
from slotstream.llm.tables import read, slices, small_batches, text_bytes
from slotstream.operators.joins import lookup
from slotstream.session import materialise

SIZE, BAND = 128, 4
# coordinates in which near-duplicates' sketches agree at least, out of SIZE: 6 standard deviations
# below what is expected at similarity 0.8
LEAST_MARKS = 75
# followers of one hub in a block; a cell compares two blocks
BLOCK = 1024
# rows of cells that one call handles
CELL_ROWS = 2048


def sketch(elements: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """The sketch of each row's elements, a row of SIZE numbers; rows without elements get the
    largest number throughout."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((n_rows, SIZE), empty)
    flat = out.reshape(-1)
    for turn in range(2 * SIZE):
        if not len(elements):
            break
        hashed = W.mix(elements ^ W.mix(np.array([turn + 1], W.U) * W.ODD)[0])
        if turn < SIZE:
            place = (hashed & W.U(SIZE - 1)).astype(np.int64)
        else:
            place = np.full(len(elements), turn - SIZE)
        value = W.U(turn) << W.U(56) | hashed >> W.U(8)
        np.minimum.at(flat, rows * SIZE + place, value)
        if turn < 4 or turn % 8 == 7:
            open_rows = (out == empty).any(axis=1)[rows]
            elements, rows = elements[open_rows], rows[open_rows]
    return out


def shingles(part: pa.RecordBatch, size: int):
    """Per row of a slice: hashes of its words (A-Z lower-cased) and of its shingles, with their
    rows. A text of fewer words than `size` is one shingle of all its words."""
    data, offsets = text_bytes(part.column("text"))
    data = W.LOWER[data]
    starts, ends, rows = W.find(data, offsets)
    hashed = W.hashes(data, starts, ends)
    found, at = W.windows(hashed, rows, size)
    owner = rows[at]
    counts = np.bincount(rows, minlength=part.num_rows)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.searchsorted(rows, short)
        whole = np.zeros(len(short), W.U)
        for k in range(size - 1):
            there = counts[short] > k
            whole[there] = W.mix(whole[there] + hashed[first[there] + k] + W.U(k + 1))
        found, owner = np.concatenate([found, whole]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    return hashed, rows, found, owner


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """`doc_id`, `copy` (digest of the word sequence), `n_shingles`, the hashes of `bands`, and
    `marks`, a byte of each coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n = part.num_rows
                hashed, rows, found, owner = shingles(part, size)
                ends = np.searchsorted(owner, np.arange(n + 1))
                distinct = [
                    len(np.unique(found[a:b])) for a, b in zip(ends, ends[1:], strict=False)
                ]
                cuts = np.searchsorted(rows, np.arange(n + 1))
                copies = [
                    blake2b(hashed[a:b].tobytes(), digest_size=16).digest()
                    for a, b in zip(cuts, cuts[1:], strict=False)
                ]
                made = sketch(found, owner, n)
                marks = (made & W.U(255)).astype(np.uint8)
                made = made.reshape(n, SIZE // BAND, BAND)
                bands = np.broadcast_to(np.arange(SIZE // BAND, dtype=W.U), made.shape[:2]).copy()
                for k in range(BAND):
                    bands = W.mix(bands * W.ODD + made[:, :, k])
                flat = pa.array(bands.reshape(-1).view(np.int64))
                at = pa.array(np.arange(n + 1, dtype=np.int32) * (SIZE // BAND))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(copies, pa.binary()),
                        pa.array(distinct, pa.int64()),
                        pa.ListArray.from_arrays(at, flat),
                        pa.array([x.tobytes() for x in marks], pa.binary()),
                    ],
                    names=["doc_id", "copy", "n_shingles", "bands", "marks"],
                )

    return docs.select("doc_id", "text").transform(small_batches).mapInArrow(
        run, "doc_id long, copy binary, n_shingles long, bands array<long>, marks binary"
    )


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """`node` and its distinct shingles, sorted, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, _, found, owner = shingles(part, size)
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
                sets = [
                    np.unique(found[a:b]).tobytes() for a, b in zip(ends, ends[1:], strict=False)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(sets, pa.binary())], names=["node", "set"]
                )

    return docs.select("node", "text").transform(small_batches).mapInArrow(run, "node long, set binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of `percent` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            left, right = batch.column("set_a"), batch.column("set_b")
            for i in range(batch.num_rows):
                a = np.frombuffer(left[i].as_buffer(), np.uint64)
                b = np.frombuffer(right[i].as_buffer(), np.uint64)
                small, large = sorted((len(a), len(b)))
                if 100 * small >= percent * large:
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    ok[i] = 100 * both >= percent * (len(a) + len(b) - both)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    with_a = lookup(pairs, sets.toDF("a", "set_a"), ["a"], "inner")
    with_b = lookup(with_a, sets.toDF("b", "set_b"), ["b"], "inner")
    return with_b.select("a", "b", "set_a", "set_b").transform(small_batches).mapInArrow(run, "a long, b long")


def cells(rows: DataFrame) -> DataFrame:
    """Deals (hub, node, component, ...) into cells: a hub's nodes form blocks, and every two
    blocks meet in one cell. Adds `cell`, `side` (which block) and `call`, which cells share."""
    sizes = rows.groupBy("hub", "component").agg(F.count(F.lit(1)).alias("n"))
    several = (
        sizes.groupBy("hub")
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"))
        .filter("parts > 1")
        .select("hub", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.col("_other")
    dealt = materialise(
        lookup(rows, several, ["hub"], "inner")
        .withColumn("side", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn(
            "cell",
            F.xxhash64("hub", F.least(F.col("side"), other), F.greatest(F.col("side"), other)),
        )
        .drop("_other", "blocks")
    )
    calls = max(1, -(-dealt.count() // CELL_ROWS))
    return dealt.withColumn("call", F.pmod(F.xxhash64("cell"), F.lit(calls)))


def each_cell(table: pa.Table) -> Iterator[pa.Table]:
    table = table.combine_chunks().sort_by([("cell", "ascending"), ("node", "ascending")])
    cell = table.column("cell").to_numpy()
    edges = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    for a, b in zip(edges, np.append(edges[1:], len(cell)), strict=True):
        yield table.slice(a, b - a)


def to_compare(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a cell's rows the component's number, the block, and those outside the largest
    component. In a cell of two blocks, only rows of different blocks are compared."""
    component = table.column("component").to_numpy()
    _, number, n = np.unique(component, return_inverse=True, return_counts=True)
    strays = np.flatnonzero(number != np.argmax(n))
    return number, table.column("side").to_numpy(), strays


def alike(table: pa.Table) -> pa.Table:
    """(hub, node) of rows whose sketch is like one in another component of the cell."""
    hubs, nodes = [], []
    for rows in each_cell(table):
        number, side, strays = to_compare(rows)
        two = side.min() != side.max()
        marks = np.frombuffer(b"".join(rows.column("marks").to_pylist()), np.uint8)
        marks = np.ascontiguousarray(marks.reshape(len(number), SIZE))
        active = np.zeros(len(number), bool)
        for some in np.array_split(strays, len(strays) // 32 + 1):
            if not len(some):
                continue
            agree = (marks[some][:, None, :] == marks[None]).sum(axis=2, dtype=np.uint8)
            near = (agree >= LEAST_MARKS) & (number[some][:, None] != number[None])
            if two:
                near &= side[some][:, None] != side[None]
            active[some] |= near.any(axis=1)
            active |= near.any(axis=0)
        hubs.append(rows.column("hub").to_numpy()[active])
        nodes.append(rows.column("node").to_numpy()[active])
    return pa.table({"hub": np.concatenate(hubs), "node": np.concatenate(nodes)})


def exact(percent: int):
    """Links between rows of different components of a cell: for every row one at most to each
    component."""

    def run(table: pa.Table) -> pa.Table:
        left, right = [], []
        for rows in each_cell(table):
            number, side, strays = to_compare(rows)
            two = side.min() != side.max()
            node = rows.column("node").to_numpy()
            raw = rows.column("set").to_pylist()
            size = np.array([len(x) // 8 for x in raw], np.int64)
            _, column = np.unique(np.frombuffer(b"".join(raw), np.uint64), return_inverse=True)
            first = np.cumsum(size) - size
            owner = np.repeat(np.arange(len(size)), size)
            order = np.argsort(column, kind="stable")
            held = owner[order]
            n = np.bincount(column)
            begin = np.cumsum(n) - n
            for row in strays.tolist():
                own = column[first[row] : first[row] + size[row]]
                reach = n[own]
                at = np.arange(reach.sum()) + np.repeat(
                    begin[own] - np.cumsum(reach) + reach, reach
                )
                both = np.bincount(held[at], minlength=len(size))
                linked = 100 * both >= percent * (size + size[row] - both)
                linked &= number != number[row]
                if two:
                    linked &= side != side[row]
                found = np.flatnonzero(linked)
                found = found[np.unique(number[found], return_index=True)[1]]
                left.append(np.full(len(found), node[row]))
                right.append(node[found])
        none = [np.zeros(0, np.int64)]
        return pa.table({"a": np.concatenate(none + left), "b": np.concatenate(none + right)})

    return run


def linked(docs: DataFrame, found: DataFrame, size: int, percent: int) -> DataFrame:
    """`node` and `component` of the documents that are linked to one of another text. `found`
    are the sketches."""
    copies = found.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    first = copies.groupBy("copy").agg(F.min("doc_id").alias("node"))
    nodes = (
        copies.alias("c")
        .join(
            first.alias("f"),
            (F.col("c.copy") == F.col("f.copy")) & (F.col("c.doc_id") == F.col("f.node")),
        )
        .select("node", F.explode("bands").alias("bucket"))
        .distinct()
    )
    shared = nodes.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialise(lookup(nodes, shared, ["bucket"], "inner"))
    met = materialise(members.groupBy("node").agg(F.sum("n").alias("met")))
    members = lookup(members.select("bucket", "node"), met, ["node"], "inner")
    hubs = members.groupBy("bucket").agg(
        F.max_by("node", F.struct("met", -F.col("node"))).alias("hub")
    )
    followers = materialise(
        lookup(members, hubs, ["bucket"], "inner")
        .filter(F.col("node") != F.col("hub"))
        .select("hub", "node")
        .distinct()
    )
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(
        met.select("node"), "node", "left_semi"
    )
    sets = shingle_sets(texts, size)
    if repeated_ids(found):
        sets = sets.groupBy("node").agg(F.max("set").alias("set"))
    sets = materialise(sets)
    links = materialise(confirmed(followers.toDF("a", "b"), sets, percent))
    reached = materialise(components(links))
    rows = lookup(followers, reached, ["node"]).withColumn(
        "component", F.coalesce("component", "node")
    )
    marks = (
        copies.select(F.col("doc_id").alias("node"), "marks")
        .join(met.select("node"), "node", "left_semi")
        .dropDuplicates(["node"])
    )
    apart = cells(rows)
    active = (
        lookup(apart, marks, ["node"], "inner")
        .groupBy("call")
        .applyInArrow(alike, "hub long, node long")
        .distinct()
    )
    apart = cells(rows.join(active, ["hub", "node"], "left_semi"))
    more = (
        lookup(apart, sets, ["node"], "inner")
        .groupBy("call")
        .applyInArrow(exact(percent), "a long, b long")
    )
    return components(links.unionByName(materialise(more)))


def repeated_ids(found: DataFrame) -> bool:
    return not found.groupBy("doc_id").count().filter("count > 1").isEmpty()


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` and `kept` for every row of `docs`: documents whose
    sets of `size`-word shingles have a Jaccard similarity of `percent` or more are linked, and
    the smallest `doc_id` that links reach names the component and is kept."""
    found = materialise(sketches(docs, size))
    reached = linked(docs, found, size, percent)
    own = found.select("doc_id", "n_shingles", "copy")
    first = (
        own.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("copy")
        .agg(F.min("doc_id").alias("node"))
    )
    first = first.join(reached, "node", "left").select(
        "copy", F.coalesce("component", "node").alias("smallest")
    )
    joined = lookup(own, first, ["copy"])
    component = F.when(
        (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("smallest")
    ).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that are kept, with their columns."""
    gone = near_duplicates(docs, size=size, percent=percent).filter(~F.col("kept"))
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), size=4)


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
  FROM words, range(1, greatest(len(w) - 3, 1) + 1) AS r(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.other
), components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN components USING (doc_id)
"""
