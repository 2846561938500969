"""Found items against the edit distance to every place of every document."""

import random

import numpy as np
import pyarrow as pa
import pytest

from slotstream.llm import decontaminate as D
from slotstream.llm.tables import read

from .conftest import SF


def words(text):
    return D.word_hashes(pa.array([text], pa.string()))[-1]


def plain_distance(item, text):
    """Fewest edits between `item` and any run of `text`."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_nearest():
    draw = random.Random(1)
    for _ in range(300):
        item = [draw.randrange(4) for _ in range(draw.randint(1, 9))]
        text = [draw.randrange(4) for _ in range(draw.randint(1, 25))]
        distance, begin, end = D.nearest(np.array(item), np.array(text))
        assert distance == plain_distance(item, text)
        assert begin <= end and plain_distance(item, text[begin:end]) == distance


def test_all_documents(spark, small, texts):
    benchmark = read(spark, SF, "benchmark")
    got = {(r.doc_id, r.item_id): r.edits for r in D.contaminated(small, benchmark).collect()}
    want = {}
    for item in benchmark.collect():
        w = words(item.text)
        for i, text in texts.items():
            own = words(text)
            if len(own) and len(w) >= D.SHORTEST:
                edits = D.nearest(w, own)[0]
                if edits <= D.allowed(len(w)):
                    want[i, item.item_id] = edits
    assert got == want and want


def edited(item, edits, draw):
    out = list(item)
    for _ in range(edits):
        at = draw.randrange(len(out))
        kind = draw.randrange(3)
        if kind == 0:
            out[at] = f"z{draw.randrange(999)}"
        elif kind == 1:
            out.insert(at, f"z{draw.randrange(999)}")
        elif len(out) > 1:
            del out[at]
    return out


def test_recall_at_the_most_edits(spark, documents):
    draw = random.Random(4)
    pool = [f"w{int(draw.paretovariate(0.6))}" for _ in range(3000)]
    items = [[draw.choice(pool) for _ in range(draw.randint(12, 70))] for _ in range(150)]
    filler = lambda: [draw.choice(pool) for _ in range(draw.randint(0, 60))]
    docs = []
    for i, item in enumerate(items):
        body = edited(item, D.allowed(len(item)), draw)
        docs.append((i, " ".join(filler() + body + filler())))
    benchmark = spark.createDataFrame(
        [(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string"
    )
    got = {(r.doc_id, r.item_id) for r in D.contaminated(documents(*docs), benchmark).collect()}
    want = {
        (i, k)
        for i, text in docs
        for k, item in enumerate(items)
        if D.nearest(words(" ".join(item)), words(text))[0] <= D.allowed(len(item))
    }
    assert got <= want
    assert len(got) >= 0.98 * len(want)


@pytest.mark.parametrize("size", [20, 40, 60, 74, 100, 300, 1000])
def test_recall_of_long_items(size):
    """At 300 words this was 0.84, at 1,000 words less than a half."""
    draw = random.Random(size)
    trials = 100 if size < 300 else 40
    items = [[f"w{draw.randrange(9999)}" for _ in range(size)] for _ in range(trials)]
    filler = lambda: [f"w{draw.randrange(9999)}" for _ in range(draw.randint(0, 200))]
    texts = [" ".join(filler() + edited(x, D.allowed(size), draw) + filler()) for x in items]
    block = D.Items.of(list(range(trials)), [" ".join(x) for x in items])
    part = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    got = {(row, number): edits for row, number, edits, *_ in D.matches(part, block)}
    assert set(got) <= {(i, i) for i in range(trials)}
    assert len(got) >= 0.98 * trials
    for i in random.Random(1).sample(sorted(got), 2):
        assert got[i] == D.nearest(words(" ".join(items[i[1]])), words(texts[i[0]]))[0]


def test_place_case_and_marks(spark, documents):
    text = "Before. “Alpha BETA, gamma; delta epsilon zeta” after"
    item = "alpha beta gamma delta epsilon zeta!"
    benchmark = spark.createDataFrame([("i", item)], "item_id string, text string")
    (row,) = D.contaminated(documents((1, text)), benchmark).collect()
    assert (row.item_id, row.item_words, row.edits) == ("i", 6, 0)
    assert text[row.start_char : row.end_char] == "Alpha BETA, gamma; delta epsilon zeta"
    clean = D.contaminated(documents((1, "alpha gamma beta")), benchmark)
    assert clean.count() == 0


@pytest.mark.parametrize(
    ("item", "text", "place"),
    [
        ("中国的首都是哪里？", "他问：“中国的首都是哪里”，我说", "中国的首都是哪里"),
        ("日本の首都、東京", "昨日「日本の首都。東京」へ", "日本の首都。東京"),
        ("เมืองหลวงของไทย", "ถามว่าเมืองหลวงของไทยคือ", "เมืองหลวงของไทย"),
        ("alpha 中国 beta", "see ALPHA中国beta。", "ALPHA中国beta"),
        ("你好", "「你好。」", "你好"),
        ("Hello!", "hello", "hello"),
        ("two words", "Two: words", "Two: words"),
        ("да؟", "«да»", "да"),
    ],
)
def test_scripts_without_blanks_and_short_items(item, text, place):
    block = D.Items.of(["i"], [item])
    part = pa.RecordBatch.from_pydict({"text": pa.array(["", text, None, "other"], pa.string())})
    ((row, number, edits, start, end),) = D.matches(part, block)
    assert (row, number, edits, text[start:end]) == (1, 0, 0, place)


def test_words_of_many_scripts():
    text = "Añb ¿x? мир\u3000中a文\U00020000\U0001f600 e\u0301 ไทย한국"
    raw, _, starts, ends, rows, _ = D.word_hashes(pa.array([None, text, "", text], pa.string()))
    got = [bytes(raw[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    want = ["Añb", "x", "мир", "中", "a", "文", "\U00020000", "\U0001f600", "e\u0301", *"ไทย", "한국"]
    assert got == want * 2 and rows.tolist() == [1] * len(want) + [3] * len(want)


def test_edges(spark, edges, none):
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "one two"), (4, "one two three four"), (4, "one two three four")],
        "item_id long, text string",
    )
    got = sorted(tuple(r)[:4] for r in D.contaminated(edges, odd).collect())
    assert got == [(7, 4, 4, 0)] * 2
    kept = D.keep(edges, odd)
    assert kept.schema == edges.schema and kept.count() == edges.count() - 1
    assert D.contaminated(none, odd).count() == 0
    assert D.contaminated(edges, odd.limit(0)).count() == 0
    assert D.keep(edges, odd.limit(0)).count() == edges.count()


def test_blocks_of_items(spark, small):
    benchmark = read(spark, SF, "benchmark")
    assert sum(len(x.ids) for x in D.blocks(benchmark, 7)) == len(next(D.blocks(benchmark)).ids)
