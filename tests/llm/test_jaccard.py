"""Grouped prefix join against all pairs, and the filters' own promises."""

import random

import numpy as np
import pytest

from slotstream.llm import jaccard, minhash
from slotstream.llm import words as W

from .test_minhash import edited, found, word_sets


def brute(texts, size, percent):
    """(n_shingles, component) by comparing all pairs."""
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
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (2, 60)])
def test_all_documents(small, texts, size, percent):
    assert found(jaccard.jaccard_join(small, size=size, percent=percent)) == brute(texts, size, percent)


@pytest.fixture(scope="module")
def families():
    """Copies of one text mostly too far from each other, a chain, sharers of a passage, near copies
    around the threshold, and sets of a few shingles."""
    draw = random.Random(11)
    out, passage = {}, [f"p{i}" for i in range(80)]
    base = [f"b{i}" for i in range(300)]
    for i in range(80):
        out[i] = " ".join(edited(base, draw, 0.012))
    chain = [f"c{i}" for i in range(120)]
    for i in range(100, 140):
        chain = [*chain[4:], f"w{i}", f"x{i}", f"y{i}", f"z{i}"]
        out[i] = " ".join(chain)
    for i in range(200, 260):
        out[i] = " ".join(passage + [f"q{draw.random()}" for _ in range(i - 198)])
    for i in range(300, 330):
        out[i] = "the very same Text in every ONE" + " " * (i - 300)
    for i in range(400, 430):
        out[i] = " ".join(draw.choice("ab") for _ in range(draw.randrange(1, 30)))
    long = [f"l{i}" for i in range(9000)]
    for i in range(500, 506):
        out[i] = " ".join(edited(long, draw, 0.015))
    return out


def test_groups_of_near_copies(documents, families):
    got = found(jaccard.jaccard_join(documents(*families.items()), size=3, percent=90))
    assert got == brute(families, 3, 90)


def test_frequent_shingles_go_last(documents, families, monkeypatch):
    """The same result when shingles of many prefixes are moved, and when blocks are small."""
    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "CELL_ROWS", 32)
    seen = []
    make = jaccard.profiles

    def profiles(docs, size, percent, late):
        seen.append(len(late))
        return make(docs, size, percent, late)

    monkeypatch.setattr(jaccard, "profiles", profiles)
    got = found(jaccard.jaccard_join(documents(*families.items()), size=3, percent=90))
    assert got == brute(families, 3, 90)
    assert seen and seen[0] > 0


def test_edges(edges):
    rows = sorted(jaccard.jaccard_join(edges, size=3, percent=90).collect(), key=str)
    assert len(rows) == 10
    by = {r.doc_id: tuple(r[1:]) for r in rows}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[5] == (0, 5)
    assert by[3] == (1, 3)
    assert [tuple(r) for r in rows if r.doc_id == 4] == [(4, 1, 3)] * 2
    assert by[None] == (3, None)


def test_one_id_with_two_texts(documents):
    same = "a b c d e f"
    rows = documents((1, same), (1, "u v w x y z"), (2, same), (3, "u v w x y z"), (4, "k l m n o"))
    got = sorted(tuple(r) for r in jaccard.jaccard_join(rows, size=3, percent=90).collect())
    assert got == [(1, 4, 1), (1, 4, 1), (2, 4, 1), (3, 4, 1), (4, 3, 4)]


def test_empty(none):
    assert jaccard.jaccard_join(none).count() == 0


def test_filters_lose_nothing():
    """Prefixes of linked sets meet under any order; signatures never lie farther apart than sets."""
    draw = np.random.default_rng(5)
    for _ in range(300):
        n = int(draw.integers(1, 6000))
        pool = draw.integers(0, 1 << 63, n + 400).astype(np.uint64) * W.ODD
        a = np.unique(pool[:n])
        cut = int(n * draw.random() * 0.12)
        b = np.unique(np.concatenate([pool[cut:n], pool[n : n + int(draw.integers(0, 1 + n // 12))]]))
        late = np.unique(draw.choice(pool, len(pool) // 3))
        both = len(np.intersect1d(a, b))
        linked = 100 * both >= 90 * (len(a) + len(b) - both)
        raw = [jaccard.signature(a), jaccard.signature(b)]
        width = min(map(len, raw)) * 8
        left, right = jaccard.folded(raw, width)
        apart = np.bitwise_count(left ^ right).sum()
        assert apart <= len(a) + len(b) - 2 * both
        if linked and both:
            assert jaccard.passes(left, len(a), right, len(b), 90)
            first = [jaccard.prefix(x, late, 90) for x in (a, b)]
            assert len(np.intersect1d(*first))
