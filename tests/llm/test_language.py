"""Accuracy on documents that taught nothing, and what is unknown."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from slotstream.llm import language
from slotstream.llm.tables import read


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = language.op8_language_id(spark, folder).collect()
    lang = {r.doc_id: r.lang for r in read(spark, folder, "documents").collect()}
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_are_not_used(spark, small, tmp_path):
    held = language.held_out(F.col("doc_id"))
    small.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang"))).withColumn(
        "source", F.lit("other")
    ).write.parquet(f"{tmp_path}/documents.parquet")
    ask = lambda folder: sorted(map(tuple, language.op8_language_id(spark, folder).collect()))
    assert ask(str(tmp_path)) == ask("/root/testdata/sf0.001")


def test_frequencies_count_every_document(small):
    df, rows = language.frequencies(small)
    import pyarrow as pa

    texts = [r.text or "" for r in small.collect()]
    found, _ = language.counts(pa.RecordBatch.from_pydict({"text": texts}))
    assert rows == len(texts) and (df == (found > 0).sum(axis=0)).all()


def test_vectors_do_not_depend_on_neighbours():
    import pyarrow as pa

    texts = ["abc def", "", None, "Éa", "x", "abc def"]
    together, letters = language.counts(pa.RecordBatch.from_pydict({"text": texts}))
    for i, text in enumerate(texts):
        alone, _ = language.counts(pa.RecordBatch.from_pydict({"text": pa.array([text], pa.string())}))
        assert (alone[0] == together[i]).all()
    assert letters.tolist() == [True, False, False, True, True, True]


def test_edges(spark, small, edges, none, documents):
    learned = language.learn(small)
    got = {r.doc_id: r for r in language.identify(edges, learned).collect()}
    for i in (1, 2, 5):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert {got[i].lang_pred for i in (3, 4, 6, 7, 8)} <= set(learned.names)
    numbers = language.identify(documents((1, "123 456 !?")), learned).collect()
    assert numbers[0].lang_pred == "und"
    assert language.identify(none, learned).count() == 0
    nothing = language.learn(small.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.identify(edges, nothing).collect()} == {"und"}


def test_far_texts_are_rejected(small, documents):
    learned = language.learn(small)
    odd = documents((1, "zzqx xqzz qqxz vvkw jjqx " * 20))
    assert language.identify(odd, learned).first().rejected
    share = language.identify(small, learned).agg(F.avg(F.col("rejected").cast("int"))).first()[0]
    assert share < 0.05
