"""Spelling variants against all pairs of words, and the bound of affected grams."""

import random
import re
import zlib
from collections import Counter

from slotstream.llm import variants


def counts(rows, least=5, every=199):
    lower = str.maketrans(variants.UPPER, variants.LOWER)
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= least}


def one_apart(a, b):
    a, b = sorted((a, b), key=len)
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a != b and (a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :])


def brute(n):
    near = {w: [x for x in n if one_apart(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def found(df):
    return {r.word: tuple(r[1:]) for r in df.collect()}


def test_all_documents(spark, small, texts):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    words = counts(rows)
    assert {r.word: r.n for r in variants.counted(small).collect()} == words
    got = found(variants.variants(variants.counted(small)))
    assert got == brute(words) and any(x[0] for x in got.values())


def made(spark, seed):
    """Words over few letters, some with accents, and chains of forms."""
    draw = random.Random(seed)
    n = {"".join(draw.choice("abé") for _ in range(draw.randrange(6, 9))): draw.randrange(5, 4000) for _ in range(500)}
    word = "abcdefgh"
    for k in range(8):
        n[word] = 5 * 6**k
        word = word[:k] + "x" + word[k + 1 :] if k % 2 else word + "z"
    return n, spark.createDataFrame(list(n.items()), "word string, n long")


def test_words_of_few_letters(spark, monkeypatch):
    """Long lists, frequent grams, equal grams in a word, ties, and forms of forms."""
    monkeypatch.setattr(variants, "LEAST_FREQUENT", 20)
    n, words = made(spark, 3)
    got = found(variants.variants(words))
    assert got == brute(n)
    assert got["abcdefgh"][1] != got["abcdefgh"][0]


def test_two_words_keep_grams_in_common():
    """Whatever grams are frequent, a near word shares all but the bound."""
    draw = random.Random(9)
    for _ in range(3000):
        word = "".join(draw.choice("abcé") for _ in range(draw.randrange(6, 14)))
        at, kind = draw.randrange(len(word) + 1), draw.randrange(3)
        other = word[:at] + (draw.choice("abcd") if kind else "") + word[at + (kind < 2) :]
        pool = [word[i : i + q] for q in (2, 3) for i in range(len(word))]
        frequent = {g for g in pool if draw.random() < 0.6}
        if len(other) < 6:
            continue
        (a, x), (b, y) = (variants.decompose(w, frequent) for w in (word, other))
        both = len(set(a) & set(b))
        assert len(set(a)) == len(a) and both >= len(a) - x >= 1 and both >= len(b) - y >= 1


def test_edges(spark, documents, edges, none):
    assert variants.variants(variants.counted(none)).count() == 0
    assert variants.near_words(variants.counted(none)).count() == 0
    variants.variants(variants.counted(edges)).collect()
    rows = [(None, "Straße élevée " * 7), (1, None), (1, ""), (2, "strasse élevés " * 30), (2, "strasse × ÷" * 3)]
    got = found(variants.variants(variants.counted(documents(*rows))))
    assert got == brute(counts(rows))
    assert got["élevée"] == (None, "élevée", 7, 1, None)
