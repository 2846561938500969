"""Near-duplicates against all pairs, and the sketch's own promises."""

import random

import numpy as np
import pytest

from slotstream.llm import minhash
from slotstream.llm import words as W
from slotstream.llm.graph import components


def word_sets(texts, size):
    out = {}
    for i, text in texts.items():
        w = (text or "").encode().translate(bytes(W.LOWER)).split()
        grams = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
        out[i] = grams or ({tuple(w)} if w else set())
    return out


def brute(texts, size):
    """(n_shingles, component, kept) by comparing all pairs."""
    sets = word_sets(texts, size)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def found(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("size", [4, 5])
def test_all_documents(small, texts, size):
    assert found(minhash.near_duplicates(small, size=size)) == brute(texts, size)


def edited(base, draw, share):
    return [f"e{draw.random()}" if draw.random() < share else w for w in base]


def test_groups_of_near_copies(documents):
    """Copies of one text that are mostly too far from each other, chains, and unlinked sharers of
    a passage."""
    draw = random.Random(7)
    pairs, passage = {}, [f"p{i}" for i in range(60)]
    base = [f"b{i}" for i in range(200)]
    for i in range(60):
        pairs[i] = " ".join(edited(base, draw, 0.02))
    chain = [f"c{i}" for i in range(100)]
    for i in range(100, 140):
        chain = chain[2:] + [f"x{i}", f"y{i}"]
        pairs[i] = " ".join(chain)
    for i in range(200, 240):
        pairs[i] = " ".join(passage + [f"q{draw.random()}" for _ in range(40)])
    for i in range(300, 330):
        pairs[i] = "the very same Text in every ONE" + " " * (i - 300)
    got = found(minhash.near_duplicates(documents(*pairs.items()), size=4))
    assert got == brute(pairs, 4)


def test_edges(edges):
    rows = sorted(minhash.near_duplicates(edges, size=4).collect(), key=str)
    assert len(rows) == 10
    by = {r.doc_id: tuple(r[1:]) for r in rows}
    assert by[1] == by[1][:0] + (0, 1, True)
    assert by[2] == (0, 2, True) and by[5] == (0, 5, True)
    assert by[3] == (1, 3, True)
    assert [tuple(r) for r in rows if r.doc_id == 4] == [(4, 1, 3, False)] * 2
    assert by[None][1:] == (None, True)


def test_empty(none):
    assert minhash.near_duplicates(none).count() == 0
    assert minhash.keep(none).count() == 0


def test_keep_has_the_same_columns(edges):
    kept = minhash.keep(edges)
    assert kept.schema == edges.schema
    assert sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == [
        1, 2, 3, 5, 6, 7, 8,
    ]
    assert kept.filter("doc_id IS NULL").count() == 1


def test_sketch_fills_and_estimates():
    draw = np.random.default_rng(3)
    pool = draw.integers(0, 1 << 63, 1000).astype(np.uint64)
    off = []
    for _ in range(50):
        a, b = pool[:900], pool[100:]
        pool = draw.permutation(pool)
        sets = np.concatenate([a, b, pool[:1]])
        rows = np.repeat([0, 1, 2], [900, 900, 1])
        made = minhash.sketch(sets, rows, 3)
        assert (made < np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        off.append((made[0] == made[1]).mean() - len(np.intersect1d(a, b)) / 1000)
    assert abs(np.mean(off)) < 0.03


def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(250)]
    links += [(1000, 1000 + i) for i in range(1, 300)] + [(i, i + 1) for i in range(2000, 2060)]
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(links, "a long, b long"))
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert found(got) == {k: (v,) for k, v in root.items() if k not in loops}
