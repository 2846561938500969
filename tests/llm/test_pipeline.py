"""The pipeline against its stages put together in plain Python, and the registered queries."""

import compare
import corpus_pipeline
import pyarrow as pa
import pytest
import __spark_entry__ as entry_file
from slotstream import llm
from slotstream.llm import decontaminate, packing, pii, quality
from slotstream.llm.tables import read

from .conftest import SF
from .test_minhash import brute


def test_stages(spark, small):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = small
    got = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == small.columns
        got.append({r.doc_id: r.text for r in docs.collect()})
    before = {r.doc_id: r.text for r in small.collect()}
    judged = quality.judge(small)
    assert got[0] == {r.doc_id: before[r.doc_id] for r in judged.filter("kept").collect()}
    kept = brute(got[0], 5)
    assert got[1] == {i: t for i, t in got[0].items() if kept[i][2]}
    items = [
        decontaminate.word_hashes(pa.array([r.text], pa.string()))[-1]
        for r in read(spark, SF, "benchmark").collect()
    ]

    def clean(text):
        own = decontaminate.word_hashes(pa.array([text], pa.string()))[-1]
        return all(
            decontaminate.nearest(x, own)[0] > decontaminate.allowed(len(x)) for x in items
        )

    assert got[2] == {i: t for i, t in got[1].items() if clean(t)}
    assert got[3] == {i: pii.replaced(t, pii.KEY)[0] for i, t in got[2].items()}
    wanted = packing.pieces(docs, packing.vocabulary(packing.VOCABULARY)).collect()
    run = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, run.select(*columns).collect())) == sorted(map(tuple, wanted))


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in llm.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(llm.QUERIES) | {"pipeline"} <= set(entry_file.queries())
    assert set(llm.ORACLES) <= set(entry_file.oracle_sql())


@pytest.mark.parametrize("name", list(llm.ORACLES))
def test_oracle(spark, name):
    con = compare.connect(SF)
    assert compare.differences(llm.QUERIES[name](spark, SF), con, llm.ORACLES[name]) is None
    con.close()


def test_results_have_the_promised_columns(spark):
    promised = {
        "op1_minhash_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
        "op2_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, "
        "grown_shard int",
        "op4_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
        "op5_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
        "op6_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
        "op8_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
        "op9_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean",
        "op10_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
        "op11_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
        "positive_score bigint, negative_score bigint",
        "op12_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
        "op13_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    }
    for name, columns in promised.items():
        got = [f"{c} {kind}" for c, kind in llm.QUERIES[name](spark, SF).dtypes]
        assert got[: columns.count(",") + 1] == columns.split(", ")
