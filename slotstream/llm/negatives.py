"""Hard negatives: rows of another label that score a little less than an anchor's best rows of its own.

Tiles. Rows are dealt into blocks by a hash of their id, anchors into slices; a tile is a block with a
slice, so every anchor meets every row, in pieces of at most BLOCK_BYTES and SLICE_BYTES of
components. This is the work of a search of all rows for each anchor; nothing is sent to the driver.

Scan. A block holds one column per dimension, and its rows are sorted by label. An anchor reads the
columns in the order of its own components, largest magnitude first. What the dimensions still unread
can add lies between sums of the columns' least and largest values times the anchor's components. With
these bounds a bitmap of candidates shrinks: a row leaves when its upper bound is below what enough
others reach for certain, or when its bounds lie outside all windows. What is left has been read
in all dimensions and has exact scores. The best of all tiles are ranked by a window that keeps
no more than is asked for.

Two scans follow each other: the first finds positives, whose scores set the windows of the second.

Arithmetic is exact: in 32-bit or 64-bit floats where sums stay below 2**24 or 2**53, else in 64-bit
integers; scores beyond those raise an error, as do components that no 32-bit integer holds.

Defined cases: rows with a NULL id, label or vector, or a NULL or non-finite component, take no part.
Shorter vectors end in zeros; an empty one scores 0. Rows with one id count once, with the smallest
(label, vector). An anchor without positives, and a positive without negatives, give no rows. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotstream.llm.tables import read
from slotstream.operators.joins import lookup
from slotstream.session import materialise

# components of a block's rows, and of a slice's anchors, at four bytes each
BLOCK_BYTES, SLICE_BYTES = 16 << 20, 2 << 20
# rows of a block at least, where smaller blocks would only keep more cores busy
LEAST_ROWS = 1024
# the bitmap is made anew after each of so many parts of the dimensions
PARTS = 8

VECTOR = "vec_id long, label long, vec array<int>"


def usable(vectors: DataFrame, label: Column, vector: Column) -> DataFrame:
    """(vec_id, label, vec): `vector` as integers, floor(256 * x)."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("int")).alias("vec"),
    )
    if not rows.groupBy("vec_id").count().filter("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("own")).select("vec_id", "own.*")
    return rows


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of `width` integers; shorter ones are filled with zeros."""
    flat = column.combine_chunks()
    lengths = np.asarray(flat.value_lengths().fill_null(0)).astype(np.int64)
    out = np.zeros((len(flat), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = np.asarray(flat.flatten())
    return out


def exact_type(anchors: np.ndarray, largest: np.ndarray) -> type:
    """A type in which sums of products with components up to `largest` are exact."""
    most = (np.abs(anchors).astype(float) @ largest.astype(float)).max(initial=0.0)
    for limit, kind in ((1 << 24, np.float32), (1 << 53, np.float64), (1 << 62, np.int64)):
        if most < limit:
            return kind
    raise OverflowError("scores do not fit 64-bit integers")


class Block:
    """Rows as columns, sorted by label and id."""

    def __init__(self, table: pa.Table, width: int, anchors: np.ndarray):
        ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        vectors = matrix(table.column("vec"), width)[order]
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)
        self.kind = exact_type(anchors, np.maximum(np.abs(self.low), np.abs(self.high)))
        self.columns = np.ascontiguousarray(vectors.T.astype(self.kind))

    def of_label(self, label: int) -> slice:
        return slice(*(int(np.searchsorted(self.labels, label, side)) for side in ("left", "right")))

    def scan(
        self, anchor: np.ndarray, alive: np.ndarray, needed: Callable[[np.ndarray, np.ndarray], np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact scores of those of the rows `alive` (a bitmap) that `needed` does not rule
        out by least and largest possible scores."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])[:, order]
        least, most = (np.append(np.cumsum(e[::-1])[::-1], 0) for e in (ends.min(axis=0), ends.max(axis=0)))
        weights = anchor.astype(self.kind)
        rows, partial = np.flatnonzero(alive), None
        whole = 2 * len(rows) > len(alive)
        checks = {len(order) * k // PARTS for k in range(1, PARTS)}
        partial = np.zeros(len(alive) if whole else len(rows), self.kind)
        for k, d in enumerate(order, 1):
            partial += weights[d] * (self.columns[d] if whole else self.columns[d, rows])
            if k not in checks:
                continue
            seen = partial[rows] if whole else partial
            bitmap = needed(seen + self.kind(least[k]), seen + self.kind(most[k]))
            left = np.count_nonzero(bitmap)
            if whole or 4 * left < 3 * len(rows):
                rows, seen = rows[bitmap], seen[bitmap]
                if whole and 2 * left > len(alive):
                    continue
                whole, partial = False, seen
        return rows, (partial[rows] if whole else partial).astype(np.int64)

    def best(self, rows: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
        """Where the first `most` by score and id stand."""
        return np.lexsort((self.ids[rows], -scores))[:most]


def reached(lower: np.ndarray, most: int):
    """What `most` rows reach for certain, if there are so many."""
    if len(lower) < most:
        return None
    return np.partition(lower, len(lower) - most)[len(lower) - most]


def best_positives(most: int):
    """Of every anchor the `most` best rows of its label in this block."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [np.zeros((0, 3), np.int64)]
        for block, anchor, vector in pairs(rows, anchors):
            own = np.zeros(len(block.ids), bool)
            own[block.of_label(anchor["label"])] = True
            own[block.ids == anchor["vec_id"]] = False

            def needed(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
                sure = reached(lower, most)
                return np.ones(len(upper), bool) if sure is None else upper >= sure

            at, scores = block.scan(vector, own, needed)
            first = block.best(at, scores, most)
            ids = np.full(len(first), anchor["vec_id"])
            out.append(np.stack([ids, block.ids[at[first]], scores[first]], axis=1))
        found = np.concatenate(out)
        return pa.table({n: found[:, i] for i, n in enumerate(("anchor_id", "positive_id", "positive_score"))})

    return run


def best_negatives(most: int, low: int, high: int):
    """Of every anchor and positive the `most` best rows of other labels in this block whose score
    is between `low` and `high` percent of the positive's."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [np.zeros((0, 5), np.int64)]
        for block, anchor, vector in pairs(rows, anchors):
            other = np.ones(len(block.ids), bool)
            other[block.of_label(anchor["label"])] = False
            scores_of = {p["score"] for p in anchor["positives"]}
            windows = {p: (-(-low * p // 100), high * p // 100) for p in scores_of if p >= 0}
            if not windows:
                continue
            floor, roof = (f(w[i] for w in windows.values()) for i, f in enumerate((min, max)))

            def needed(lower, upper, windows=windows, floor=floor, roof=roof) -> np.ndarray:
                near = (upper >= floor) & (lower <= roof)
                lower, upper = lower[near], upper[near]
                keep = np.zeros(len(lower), bool)
                for least, largest in windows.values():
                    sure = reached(lower[(lower >= least) & (upper <= largest)], most)
                    keep |= (upper >= (least if sure is None else sure)) & (lower <= largest)
                near[near] = keep
                return near

            at, scores = block.scan(vector, other, needed)
            for positive in anchor["positives"]:
                least, largest = windows.get(positive["score"], (1, 0))
                inside = np.flatnonzero((scores >= least) & (scores <= largest))
                first = inside[block.best(at[inside], scores[inside], most)]
                own = np.broadcast_to(
                    [anchor["vec_id"], positive["id"], positive["score"]], (len(first), 3)
                )
                out.append(np.column_stack([own, block.ids[at[first]], scores[first]]))
        found = np.concatenate(out)
        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        return pa.table({n: found[:, i] for i, n in enumerate(names)})

    return run


def pairs(rows: pa.Table, anchors: pa.Table) -> Iterator[tuple[Block, dict, np.ndarray]]:
    """A tile's block with each of its anchors and the anchor's vector."""
    if not rows.num_rows or not anchors.num_rows:
        return
    width = max(int(np.asarray(t.column("vec").combine_chunks().value_lengths()).max()) for t in (rows, anchors))
    vectors = matrix(anchors.column("vec"), width)
    block = Block(rows, width, vectors)
    kept = [c for c in anchors.column_names if c != "vec"]
    for anchor, vector in zip(anchors.select(kept).to_pylist(), vectors, strict=True):
        yield block, anchor, vector


class Tiles:
    """How many blocks and slices the rows and anchors make."""

    def __init__(self, vectors: DataFrame, anchors: DataFrame):
        n, width = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
        bytes_each = 4 * max(width, 1)
        cores = vectors.sparkSession.sparkContext.defaultParallelism
        self.blocks = max(1, -(-n * bytes_each // BLOCK_BYTES), min(-(-n // LEAST_ROWS), 2 * cores))
        self.slices = max(1, -(-anchors.count() * bytes_each // SLICE_BYTES))

    def meet(self, vectors: DataFrame, anchors: DataFrame, run, schema: str) -> DataFrame:
        """`run` on every block with every slice."""
        spread = F.pmod(F.xxhash64("vec_id"), F.lit(self.blocks)), F.pmod(F.xxhash64("vec_id"), F.lit(self.slices))
        every = [F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1))) for n in (self.blocks, self.slices)]
        left = vectors.withColumns({"block": spread[0], "slice": every[1]}).groupBy("block", "slice")
        right = anchors.withColumns({"slice": spread[1], "block": every[0]}).groupBy("block", "slice")
        return left.cogroup(right).applyInArrow(run, schema)


def first_of(df: DataFrame, keys: list[str], score: str, tie: str, most: int) -> DataFrame:
    ranked = df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(score), tie)))
    return ranked.filter(F.col("rank") <= most)


def mine(
    vectors: DataFrame, anchor: Column, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """Of the rows (vec_id, label, vec) that are an `anchor`, and each of its first `positives` other
    rows of the same label, the first `negatives` rows of another label whose score is between
    `low` and `high` percent of the positive's score. The score is the inner product with the anchor."""
    vectors = materialise(vectors)
    anchors = vectors.filter(anchor)
    tiles = Tiles(vectors, anchors)
    found = tiles.meet(
        vectors, anchors, best_positives(positives), "anchor_id long, positive_id long, positive_score long"
    )
    best = first_of(found, ["anchor_id"], "positive_score", "positive_id", positives)
    best = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias(
            "positives"
        )
    )
    known = materialise(lookup(anchors, best, ["vec_id"], "inner"))
    found = tiles.meet(
        vectors,
        known,
        best_negatives(negatives, low, high),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    ranked = first_of(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(usable(rows, label, F.col("embedding")), F.col("vec_id") % 100 == 0)


OP11_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
    list_inner_product(a.vec, v.vec)::BIGINT AS score
  FROM v a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
