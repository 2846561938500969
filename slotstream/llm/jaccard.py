"""Documents whose sets of word shingles are alike: a prefix join over groups.

Order. All shingles have one order: by 64-bit hash, frequent ones last. A document's prefix are the
first n - ceil(t n) + 1 of its n shingles; two documents of similarity t or more share a shingle of
both prefixes, whatever the order is. Which shingles are frequent is counted over the prefixes that
hashes alone give, of all documents. Lists that are long all the same cost time, not links.

Groups. Equal sets are one node. Nodes of equal prefix and size form a group, which stands in the
lists of its prefix once, by its smallest node. Lists are split into classes of size, such that linked
sizes share one. Pairs of groups are filtered by size and by
signature: a parity bitmap of the set, whose Hamming distance to another one never exceeds the
number of shingles that only one of the sets has. Nothing that is linked fails these filters.

Pairs. A list of n groups has n squared pairs, and only components are asked for. So the groups of a
list are first compared with its hub, the group that meets most others, and the members of a group
with its smallest node; what passes the filters is verified on full sets. Then groups are
expanded: members of the groups that follow one hub, if they are in several components, are
compared in cells of bounded size, by signature and then on full sets. Every two documents that
share a prefix shingle are thus compared, told apart by a filter, or in one component already.

Defined cases: NULL and empty texts, and texts without words, have empty sets and are linked with
nothing. A NULL `doc_id` is linked with nothing and has a NULL component. Repeated rows give a row
each. Rows of one `doc_id` with different sets are judged by their own sets; where that id is the
smallest of two sets, the set of the smaller digest stands for both. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm import words as W
from slotstream.llm.graph import components
from slotstream.llm.minhash import cells, confirmed, each_cell, exact, repeated_ids, shingles, to_compare
from slotstream.llm.tables import read, slices, small_batches
from slotstream.operators.joins import lookup
from slotstream.session import materialise

# documents that hold a frequent shingle in their prefix; more where there would be too many such
# shingles, as they are sent to all executors: 8 MB at most
FREQUENT, MOST_FREQUENT = 64, 1 << 20
# bits of the smallest signature, and shingles for each bit of larger ones
BITS, PER_BIT = 512, 4
# bits of the filter that tells for which documents sets are wanted: 8 MB
WANTED_BITS = 1 << 26

PROFILE = "doc_id long, digest binary, n_shingles long, prefix array<long>, lead binary, sign binary"


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of `n` shares at least with any set it is linked to."""
    return -(-percent * n // 100)


def signature(found: np.ndarray) -> bytes:
    """A parity bitmap: a bit is set if an odd number of the set's hashes fall on it. The larger
    half of a wide one, laid over the smaller by exclusive or, gives the next narrower one."""
    width = BITS
    while width * PER_BIT < len(found):
        width *= 2
    bits = np.bincount((found >> W.U(20) & W.U(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((bits & 1).astype(np.uint8), bitorder="little").tobytes()


def distinct_sets(part: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """The distinct shingles of each row, sorted."""
    _, _, found, owner = shingles(part, size)
    ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
    return [np.unique(found[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def digest(found: np.ndarray) -> bytes:
    return blake2b(found.tobytes(), digest_size=16).digest()


def prefix(found: np.ndarray, late: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a sorted set; those in `late` (sorted) come after all others."""
    n = len(found)
    if not n:
        return found
    if len(late):
        last = late[np.minimum(np.searchsorted(late, found), len(late) - 1)] == found
        found = np.concatenate([found[~last], found[last]])
    return found[: n - least_overlap(n, percent) + 1]


def frequent(docs: DataFrame, size: int, percent: int) -> np.ndarray:
    """The shingles that more than FREQUENT documents hold in their prefix by hash, sorted; at most
    MOST_FREQUENT, as the least count grows with the prefixes."""
    none = np.zeros(0, W.U)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                first = [prefix(x, none, percent) for x in distinct_sets(part, size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([none, *first]).view(np.int64))], names=["token"]
                )

    tokens = docs.select("text").transform(small_batches).mapInArrow(run, "token long")
    counts = materialise(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FREQUENT))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = counts.filter(F.col("n") > total // MOST_FREQUENT).select("token").toArrow()
    return np.sort(rows.column("token").to_numpy().astype(np.int64).view(W.U))


def profiles(docs: DataFrame, size: int, percent: int, late: np.ndarray) -> DataFrame:
    """Of every row the digest of its set, the set's size, prefix and signature, and `lead`, a
    digest of prefix and size."""
    shared = docs.sparkSession.sparkContext.broadcast(late)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = distinct_sets(part, size)
                first = [prefix(x, shared.value, percent) for x in sets]
                at = np.cumsum([0, *map(len, first)]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, W.U), *first]).view(np.int64)
                leads = [
                    blake2b(f.tobytes(), digest_size=16, salt=len(x).to_bytes(8, "little")).digest()
                    for f, x in zip(first, sets, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(map(digest, sets), pa.binary()),
                        pa.array(map(len, sets), pa.int64()),
                        pa.ListArray.from_arrays(at, pa.array(flat)),
                        pa.array(leads, pa.binary()),
                        pa.array(map(signature, sets), pa.binary()),
                    ],
                    names=["doc_id", "digest", "n_shingles", "prefix", "lead", "sign"],
                )

    return docs.select("doc_id", "text").transform(small_batches).mapInArrow(run, PROFILE)


def place(ids: np.ndarray) -> np.ndarray:
    return (W.mix(ids.view(W.U)) & W.U(WANTED_BITS - 1)).astype(np.int64)


def wanted(nodes: DataFrame) -> np.ndarray:
    """A bitmap of WANTED_BITS in which the place of every node is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(place(batch.column("node").to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> 6), pa.array(np.left_shift(np.int64(1), at & 63))],
                names=["word", "bits"],
            )

    words = nodes.select("node").mapInArrow(run, "word long, bits long")
    rows = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(WANTED_BITS >> 6, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out


def sets_of(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """`node`, `digest` and the set of all documents whose id is in `nodes`, and of some others."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = place(batch.column("node").to_numpy(zero_copy_only=False))
            some = batch.filter(pa.array(shared.value[at >> 6] >> (at & 63) & 1 == 1))
            for part in slices(some, "text"):
                sets = distinct_sets(part, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("node"),
                        pa.array(map(digest, sets), pa.binary()),
                        pa.array([x.tobytes() for x in sets], pa.binary()),
                    ],
                    names=["node", "digest", "set"],
                )

    rows = docs.filter(F.col("doc_id").isNotNull())
    return (
        rows.select(F.col("doc_id").cast("long").alias("node"), "text")
        .transform(small_batches)
        .mapInArrow(run, "node long, digest binary, set binary")
    )


def folded(raw: list[bytes], width: int) -> np.ndarray:
    """Signatures as rows of 64-bit numbers, folded to `width` bits."""
    out = np.empty((len(raw), width // 64), W.U)
    for i, x in enumerate(raw):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(x, W.U).reshape(-1, width // 64), axis=0)
    return out


def passes(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, percent: int):
    """Whether sets of these signatures and sizes can be linked; arrays are broadcast."""
    apart = np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)
    near = (100 + percent) * apart <= (100 - percent) * (n_a + n_b)
    return near & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the filters of size and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            left, right = (batch.column(c).to_pylist() for c in ("sign_a", "sign_b"))
            width = np.array([min(len(x), len(y)) * 8 for x, y in zip(left, right, strict=True)])
            ok = np.zeros(batch.num_rows, bool)
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                a, b = (folded([x[i] for i in at], w) for x in (left, right))
                ok[at] = passes(a, n_a[at], b, n_b[at], percent)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    own = nodes.select("node", "n_shingles", "sign")
    both = lookup(pairs, own.toDF("a", "n_a", "sign_a"), ["a"], "inner")
    both = lookup(both, own.toDF("b", "n_b", "sign_b"), ["b"], "inner")
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return both.filter(sizes).transform(small_batches).mapInArrow(run, "a long, b long")


def alike(percent: int):
    """(hub, node) of a cell's rows that pass the filters with a row of another component."""

    def run(table: pa.Table) -> pa.Table:
        hubs, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for rows in each_cell(table):
            number, side, strays = to_compare(rows)
            two = side.min() != side.max()
            n = rows.column("n_shingles").to_numpy()
            raw = rows.column("sign").to_pylist()
            bits = np.array([len(x) * 8 for x in raw])
            active = np.zeros(len(number), bool)
            for width in np.unique(bits[strays]):
                own = strays[bits[strays] == width]
                # sizes of linked sets differ by less than a factor of two, so widths do too
                for w in (width // 2, width, 2 * width):
                    rest = np.flatnonzero(bits == w)
                    if not len(rest):
                        continue
                    narrow = min(w, width)
                    right = folded([raw[i] for i in rest], narrow)
                    left = folded([raw[i] for i in own], narrow)
                    step = max(1, (1 << 21) // (right.size + 1))
                    for i in range(0, len(own), step):
                        some = own[i : i + step]
                        near = passes(
                            left[i : i + step, None], n[some][:, None], right[None], n[rest], percent
                        )
                        near &= number[some][:, None] != number[rest]
                        if two:
                            near &= side[some][:, None] != side[rest]
                        active[some] |= near.any(axis=1)
                        active[rest] |= near.any(axis=0)
            hubs.append(rows.column("hub").to_numpy()[active])
            nodes.append(rows.column("node").to_numpy()[active])
        return pa.table({"hub": np.concatenate(hubs), "node": np.concatenate(nodes)})

    return run


def distinct_nodes(found: DataFrame) -> DataFrame:
    """One row for each distinct set: `node` is its smallest `doc_id`."""
    own = F.struct("n_shingles", "prefix", "lead", "sign")
    nodes = (
        found.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first(own).alias("own"))
        .select("node", "digest", "own.*")
    )
    if repeated_ids(found):
        one = F.min(F.struct("digest", *[c for c in nodes.columns if c not in ("node", "digest")]))
        nodes = nodes.groupBy("node").agg(one.alias("own")).select("node", "own.*")
    return materialise(nodes)


def grouped(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes with the smallest one of their `group`, of equal prefix and size, and how many
    groups hold a shingle in their prefix (token, n), where several do."""
    first = nodes.groupBy("lead").agg(F.min("node").alias("group"))
    members = materialise(lookup(nodes, first, ["lead"], "inner").drop("lead"))
    counts = listed(members).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return members, materialise(counts.filter("n > 1"))


def listed(members: DataFrame) -> DataFrame:
    """(token, group, n_shingles): the lists of all prefix shingles."""
    heads = members.filter(F.col("node") == F.col("group"))
    return heads.select(F.explode("prefix").alias("token"), "group", "n_shingles")


def by_size(held: DataFrame, percent: int) -> DataFrame:
    """(token, group) with a list of its own for each class of sizes; a group is in two classes, and
    sizes that can be linked share one."""
    # a little wider than the largest step between linked sizes, as logarithms are rounded
    width = math.log(100 / percent) * 1.0001 if percent < 100 else 1.0
    own = F.floor(F.log("n_shingles") / width)
    classes = held.withColumn("class", F.explode(F.array(own, own + 1)))
    return classes.select(F.xxhash64("token", "class").alias("token"), "group")


def followers(members: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """(hub, group): the groups of every list and class of sizes with its hub, and the groups of
    several members with themselves. A hub follows itself."""
    held = materialise(lookup(listed(members), lists.select("token"), ["token"], "inner"))
    held = by_size(held, percent)
    shared = held.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = materialise(lookup(held, shared, ["token"], "inner"))
    met = held.groupBy("group").agg(F.sum("n").alias("met"))
    hubs = (
        lookup(held.select("token", "group"), met, ["group"], "inner")
        .groupBy("token")
        .agg(F.max_by("group", F.struct("met", -F.col("group"))).alias("hub"))
    )
    pairs = lookup(held.select("token", "group"), hubs, ["token"], "inner").select("hub", "group")
    several = members.filter(F.col("node") != F.col("group"))
    return materialise(
        pairs.unionByName(several.select(F.col("group").alias("hub"), "group")).distinct()
    )


def linked(docs: DataFrame, members: DataFrame, lists: DataFrame, size: int, percent: int) -> DataFrame:
    """`node` and `component` of the nodes that are linked to another one."""
    again = repeated_ids(docs)

    def sets(some: DataFrame) -> DataFrame:
        made = sets_of(docs, some, size)
        if again:
            own = members.select("node", "digest")
            made = made.join(own, ["node", "digest"], "left_semi").dropDuplicates(["node"])
        return materialise(made.select("node", "set"))

    follow = followers(members, lists, percent)
    own = members.select(F.col("group").alias("a"), F.col("node").alias("b"))
    pairs = follow.toDF("a", "b").unionByName(own).filter("a != b").distinct()
    pairs = materialise(plausible(pairs, members, percent))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    links = materialise(confirmed(pairs, sets(ends), percent))
    reached = components(links)
    # groups expand to members where a hub's followers are in several components
    known = materialise(
        lookup(members.select("node", "group", "n_shingles", "sign"), reached, ["node"]).withColumn(
            "component", F.coalesce("component", "node")
        )
    )
    parts = known.groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = (
        lookup(follow, parts, ["group"], "inner")
        .groupBy("hub")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .filter("low < high")
        .select("hub")
    )
    rows = lookup(follow, several, ["hub"], "inner").join(known, "group").drop("group")
    rows = materialise(rows)
    active = cells(rows).groupBy("call").applyInArrow(alike(percent), "hub long, node long").distinct()
    rows = materialise(rows.drop("sign", "n_shingles").join(active, ["hub", "node"], "left_semi"))
    more = (
        lookup(cells(rows), sets(rows.select("node")), ["node"], "inner")
        .groupBy("call")
        .applyInArrow(exact(percent), "a long, b long")
    )
    return components(links.unionByName(materialise(more)))


def jaccard_join(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """`doc_id`, `n_shingles` and `component_id` for every row of `docs`: documents whose sets of
    `size`-word shingles have a Jaccard similarity of `percent` (over 50) or more are linked, and
    the smallest `doc_id` that links reach names the component."""
    found = materialise(profiles(docs, size, percent, frequent(docs, size, percent)))
    members, lists = grouped(distinct_nodes(found))
    reached = linked(docs, members, lists, size, percent)
    own = found.select("doc_id", "n_shingles", "digest")
    has_links = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    first = own.filter(has_links).groupBy("digest").agg(F.min("doc_id").alias("node"))
    first = lookup(first, reached, ["node"]).select("digest", F.coalesce("component", "node").alias("smallest"))
    return lookup(own, first, ["digest"]).select(
        "doc_id",
        "n_shingles",
        F.when(has_links, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents"), size=3, percent=90)


OP13_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM words, range(1, greatest(len(w) - 2, 1) + 1) AS r(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.other
), components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN components USING (doc_id)
"""
