"""Balance, places, groups and sizes."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from slotstream.llm import sharding
from slotstream.llm.tables import read


def checked(df, texts, shards=40):
    rows = df.collect()
    sizes = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == sizes
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(0 <= s < shards for s in slots)
    total = Counter()
    for r in rows:
        total[r.shard] += r.size
    return rows, total


def test_documents_are_balanced(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows, total = checked(sharding.numbered(docs), texts)
    mean = sum(total.values()) / 40
    assert max(total.values()) < 1.05 * mean and min(total.values()) > 0.95 * mean
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 4


def test_groups_stay_together_unless_they_are_heavy(documents):
    light = [(i, f"text {i // 2} " + "w " * 200) for i in range(4000)]
    heavy = [(10_000 + i, "the same " * 100) for i in range(3000)]
    rows, total = checked(sharding.numbered(documents(*light, *heavy)), light + heavy)
    shards = defaultdict(set)
    for r in rows:
        shards[r.text_crc32].add(r.shard)
    crc = zlib.crc32(("the same " * 100).encode())
    assert len(shards.pop(crc)) > 20
    assert all(len(x) == 1 for x in shards.values())
    mean = sum(total.values()) / 40
    assert max(total.values()) < 1.1 * mean and min(total.values()) > 0.9 * mean


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_no_group_that_fits_is_split(spark, sf):
    docs = read(spark, f"/root/testdata/{sf}", "documents")
    rows = sharding.assign(docs).collect()
    own, total, count = defaultdict(list), Counter(), Counter()
    for r in rows:
        own[r.text_crc32, r.size].append(r)
        total[r.shard] += r.size
        count[r.shard] += 1
    groups = [g for g in own.values() if len(g) > 1]
    assert len(groups) > 50
    for g in groups:
        share = max(sum(r.size for r in g) / sum(total.values()), len(g) / len(rows)) * 40
        assert share > 1 or len({r.shard for r in g}) == 1
    mean = sum(total.values()) / 40
    assert max(total.values()) < 1.05 * mean and min(total.values()) > 0.95 * mean
    assert max(count.values()) - min(count.values()) <= (8 if sf == "sf0.01" else 12)


def test_bins_are_those_of_a_plain_packing(spark, monkeypatch):
    """Where every group is heavy there are no blocks: largest first, each where the dot product
    with what is left is highest."""
    monkeypatch.setattr(sharding, "GRAIN", 0.0)
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    demand = defaultdict(lambda: [0, 0, 0])
    for r in docs.collect():
        text = r.text or ""
        own = demand[hashlib.md5(text.encode()).digest()]
        own[0] += len(text.encode()) + 16
        own[1] += len(re.findall(sharding.WORD, text))
        own[2] += 1
    mean = [sum(d[k] for d in demand.values()) / 3 for k in range(3)]
    need = {c: [x / m for x, m in zip(d, mean, strict=True)] for c, d in sorted(demand.items())}
    assert all(0 < max(n) <= 1 for n in need.values())
    left, wanted = [[1.0] * 3 for _ in range(3)], {}
    for c in sorted(need, key=lambda c: -max(need[c])):
        score = [sum(x * y for x, y in zip(l, need[c], strict=True)) for l in left]
        best = score.index(max(score))
        wanted[c] = best
        left[best] = [x - y for x, y in zip(left[best], need[c], strict=True)]
    text = {r.doc_id: hashlib.md5((r.text or "").encode()).digest() for r in docs.collect()}
    got = {text[r.doc_id]: r.shard for r in sharding.assign(docs, shards=3).collect()}
    assert got == wanted


def test_edges(edges, none):
    texts = [(r.doc_id, r.text) for r in edges.collect()]
    checked(sharding.numbered(edges), texts)
    checked(sharding.numbered(edges, shards=3), texts, 3)
    assert sharding.numbered(none).count() == 0


def test_blocks_are_turned(documents, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_GROUPS", 50)
    texts = [(i, f"{i} " + "word " * (i % 90)) for i in range(2000)]
    _, total = checked(sharding.numbered(documents(*texts)), texts)
    mean = sum(total.values()) / 40
    assert max(total.values()) < 1.1 * mean and min(total.values()) > 0.9 * mean
