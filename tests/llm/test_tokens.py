"""Ids, counts and packing against the tokenizer library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from slotstream.llm import encode, packing, tokens
from slotstream.session import run_dir

VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = [
    "a", "the", " ", "  ", "\n", "\t", "\r\n", "é", "É", "'s", "'", "1", "<|endoftext|>", "你",
    "\x1c", "́", "!", ".", "ß", "İ", "Σ", " ", " ", "\x00", "ſ", "<|startoftext|>",
]


def whole(name, texts):
    made = Tokenizer.from_file(packing.vocabulary(name))
    return [made.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_words_give_the_ids_of_whole_texts(name, texts):
    draw = random.Random(1)
    odd = ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 12))) for _ in range(4000)]
    every = [*texts.values(), *odd]
    want = whole(name, every)
    made = encode.Encoder(packing.vocabulary(name), remembered=500)
    for at in range(0, len(every), 300):
        got = made.ids(every[at : at + 300])
        assert [x.tolist() for x in got] == want[at : at + 300]
        assert made.counts(every[at : at + 300]) == [len(x) for x in want[at : at + 300]]


def counted(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def wanted(docs):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    ids = whole(tokens.VOCABULARY, [t for _, t in rows])
    return sorted(
        ((i, len(t.encode()), len(x), len(x) > 2048) for (i, t), x in zip(rows, ids, strict=True)),
        key=str,
    )


def test_counts(spark, small):
    assert counted(tokens.op6_token_counts(spark, "/root/testdata/sf0.001")) == wanted(small)


def test_the_cache_is_used(spark, documents, edges, none, monkeypatch):
    path, cache = packing.vocabulary(tokens.VOCABULARY), run_dir(spark, "cache")
    assert tokens.counts(none, path, cache).count() == 0
    assert counted(tokens.counts(edges, path, cache)) == wanted(edges)
    stored = spark.read.parquet(cache).count()
    more = documents((1, "one"), (2, "one"), (3, "quite new"), (4, "quite new"))
    assert counted(tokens.counts(more, path, cache)) == wanted(more)
    assert spark.read.parquet(cache).count() == stored + 1
    # a stored count is taken, and one of another tokenizer version is not
    fake = [(bytes.fromhex(tokens.hashlib.sha256(b"fake").hexdigest()), v, n) for v, n in (
        (tokens.version_of(path), 777), ("other", 5))]
    spark.createDataFrame(fake, tokens.CACHE).write.mode("append").parquet(cache)
    (row,) = tokens.counts(documents((9, "fake")), path, cache).collect()
    assert row.n_tokens == 777


def checked(docs, capacity=1024):
    """Every id lies in one piece, and sequences have no gaps."""
    path = packing.vocabulary(packing.VOCABULARY)
    rows = packing.pack(docs, path, capacity=capacity).collect()
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    left = defaultdict(list)
    for (i, _), ids in zip(texts, whole(packing.VOCABULARY, [t for _, t in texts]), strict=True):
        left[i].append([*ids, 0])
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
    crcs = defaultdict(list)
    for i, found in left.items():
        for ids in found:
            for at in range(0, len(ids), capacity):
                part = np.array(ids[at : at + capacity], "<u4")
                crcs[i].append((at, len(part), zlib.crc32(part.tobytes()), len(ids)))
    got = defaultdict(list)
    windows = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        windows[r.sequence_id].append((r.offset, r.length, r.sequence_tokens, r.padded_to))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in crcs.items()}
    for parts in windows.values():
        at = 0
        for offset, length, filled, padded in sorted(parts):
            assert offset == at
            at += length
        assert at == filled <= capacity
        assert padded == (filled if filled & (filled - 1) == 0 else capacity)
    assert sorted(windows) == list(range(len(windows)))
    return windows


def test_packing(small):
    windows = checked(small)
    total = sum(x[1] for parts in windows.values() for x in parts)
    assert len(windows) <= -(-total // 1024) * 1.05 + 1


def test_packing_edges(edges, none):
    checked(edges)
    checked(edges, capacity=7)
    assert packing.pack(none, packing.vocabulary(packing.VOCABULARY)).count() == 0


def test_fill_is_the_closest_multiset():
    draw = random.Random(3)
    for _ in range(200):
        counts = {draw.randint(1, 20): draw.randint(1, 3) for _ in range(draw.randint(1, 6))}
        chosen = packing.fill(dict(counts), 23)
        assert max(counts) in chosen
        assert all(0 < c <= counts[n] for n, c in chosen.items())
        sums = {max(counts)}
        for n, c in counts.items():
            have = c - (n == max(counts))
            sums = {s + n * k for s in sums for k in range(have + 1)}
        assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= 23)


def test_plan_places_everything():
    draw = random.Random(4)
    counts = {n: draw.randint(1, 5000) for n in range(1, 300, 7)} | {1024: 12345}
    rows = packing.plan(counts, 1024)
    placed = defaultdict(int)
    for length, first, last, per, _, _, filled in rows:
        assert placed[length] == first and (last - first) % per == 0 and filled <= 1024
        placed[length] = last
    assert placed == counts


@pytest.mark.parametrize("name", VOCABULARIES)
def test_what_a_worker_remembers_is_bounded(name, monkeypatch):
    """Texts without blanks, and pieces of great length, give the same ids and are not held."""
    monkeypatch.setattr(encode, "FIRSTS", 100)
    draw = random.Random(3)
    letters = "的一是不了人我在有他这中大来上国" + "abcdefgh"
    word = lambda n: "".join(draw.choices(letters[16:], k=n))
    texts = ["".join(draw.choices(letters[:16], k=30)) + str(i) for i in range(1000)]
    texts += [f"{word(5)} {word(150)} {word(9)}" for i in range(1000)]
    texts += [f"{word(5)} {word(1000)} {word(9)}" for i in range(200)]
    want = whole(name, texts)
    made = encode.Encoder(packing.vocabulary(name), chars=20_000)
    for at in range(0, len(texts), 50):
        assert [x.tolist() for x in made.ids(texts[at : at + 50])] == want[at : at + 50]
        assert len(made.firsts) <= 100
        # what was held before, and the pieces of one call
        assert made.words.chars == sum(map(len, made.names)) <= 20_000 + 50 * 200
        assert max(map(len, made.names), default=0) <= encode.LONGEST
    assert made.counts(texts) == [len(x) for x in want]


@pytest.mark.parametrize("tasks", [1, 7])
def test_one_text_without_ids_is_encoded_once_a_task(spark, tasks):
    rows = spark.createDataFrame([(None, "same text")] * 500 + [(1, "other")], "doc_id long, text string")
    cache = run_dir(spark, "cache")
    path = packing.vocabulary(tokens.VOCABULARY)
    assert len(tokens.counts(rows.repartition(tasks), path, cache).collect()) == 501
    assert 2 <= spark.read.parquet(cache).count() <= 1 + tasks
