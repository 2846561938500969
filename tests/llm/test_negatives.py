"""Hard negatives against all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotstream.llm import negatives
from slotstream.llm.tables import read

from .conftest import SF


def brute(rows, every=100, positives=5, most=10):
    """`rows` are (vec_id, label, integer vector)."""
    out = []
    for i, label, vector in rows:
        if i % every:
            continue
        score = {j: sum(x * y for x, y in zip(vector, other, strict=False)) for j, _, other in rows}
        same = sorted((j for j, own, _ in rows if own == label and j != i), key=lambda j: (-score[j], j))
        rest = sorted((j for j, own, _ in rows if own != label), key=lambda j: (-score[j], j))
        for p in same[:positives]:
            fit = [j for j in rest if 30 * score[p] <= 100 * score[j] <= 90 * score[p]]
            out += [(i, p, k, j, score[p], score[j]) for k, j in enumerate(fit[:most], 1)]
    return sorted(out)


def mined(spark, rows, **kind):
    df = spark.createDataFrame(rows, negatives.VECTOR)
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 100 == 0, **kind).collect()))


def test_all_rows(spark):
    got = sorted(map(tuple, negatives.op11_hard_negatives(spark, SF).collect()))
    rows = [
        (r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [math.floor(256 * x) for x in r.embedding])
        for r in read(spark, SF, "embeddings").collect()
    ]
    assert got == brute(rows) and got


@pytest.mark.parametrize("size", [3, 1 << 12, 1 << 29])
def test_ties_and_every_kind_of_number(spark, monkeypatch, size):
    """Few values and so many ties, vectors of several lengths, scores below zero; sums that need
    wider numbers; many blocks and slices."""
    monkeypatch.setattr(negatives, "LEAST_ROWS", 50)
    monkeypatch.setattr(negatives, "SLICE_BYTES", 64)
    draw = random.Random(size)
    rows = [
        (i, draw.randrange(3), [draw.randrange(-size, size + 1) for _ in range(draw.choice((12, 12, 7, 0)))])
        for i in range(0, 1000, 2)
    ]
    rows += [(i, 1, rows[40][2]) for i in range(1001, 1101, 2)]
    assert mined(spark, rows) == brute(rows)


def test_long_vectors_are_pruned(spark, monkeypatch):
    draw = np.random.default_rng(4)
    scale = np.geomspace(400, 1, 96)
    rows = [(i, int(draw.integers(0, 2)), (draw.normal(size=96) * scale).astype(int).tolist()) for i in range(3000)]
    assert mined(spark, rows) == brute(rows)
    vectors = np.array([v for *_, v in rows])
    table = spark.createDataFrame(rows, negatives.VECTOR).toArrow()
    block = negatives.Block(table, 96, vectors[:1])
    asked = []

    def needed(lower, upper):
        asked.append(len(upper))
        return upper >= negatives.reached(lower, 5)

    at, scores = block.scan(vectors[0], np.ones(3000, bool), needed)
    assert asked[-1] < 100 and sorted(scores)[-5:] == sorted(vectors @ vectors[0])[-5:]


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [0.5, 0.5], "a"), (0, 1, [0.5, 0.5], "b"), (0, 2, [9.0, 9.0], "c"), (1, 1, [0.5, 0.25], "d"),
        (2, None, [0.5, 0.5], "e"), (3, 2, None, "f"), (4, 2, [0.5, None], "g"), (5, 2, [nan, 0.5], "h"),
        (6, 2, [-inf, 0.5], "i"), (None, 2, [0.5, 0.5], "j"), (8, 2, [0.25, 0.25], "k"), (9, 2, [0.25], "l"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, block string")
    made = negatives.usable(df, F.col("label"), F.col("embedding"))
    assert sorted(r.vec_id for r in made.collect()) == [0, 1, 8, 9]
    got = negatives.mine(made, F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 8, 24576, 16384), (0, 1, 2, 9, 24576, 8192)]


def test_empty(spark):
    none = spark.createDataFrame([], negatives.VECTOR)
    assert negatives.mine(none, F.col("vec_id") % 100 == 0).count() == 0
    alone = [(100, 1, [1, 2]), (3, 2, [1, 2])]
    assert mined(spark, alone) == []
    assert mined(spark, [(3, 2, [1, 2])]) == []
