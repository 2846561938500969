"""Formatted conversations read back exactly."""

import hashlib
import time

import compare
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from slotstream.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, turns string"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_oracle(spark, sf):
    folder = f"/root/testdata/{sf}"
    con = compare.connect(folder)
    assert compare.differences(chat.op4_chat_format(spark, folder), con, chat.OP4_SQL) is None
    con.close()


def wanted(turns):
    """(n_turns, turns_sha256, loss_chars, loss_sha256) of sorted (turn, role, text)."""
    body = "".join(f"{r}\n{t}\n" for _, r, t in turns)
    loss = "".join(t for _, r, t in turns if r == "assistant")
    return (
        len(turns),
        hashlib.sha256(body.encode()).hexdigest(),
        len(loss),
        hashlib.sha256(loss.encode()).hexdigest(),
    )


PARTS = ["<|end|>", "<|next|>", "<|role:", "|>", "<|", "\\", "\\\\", "<\\|", "|\\>", "a", "é", "\n", "\U0001f600", "<", "|", ">", ""]
SPELLED = st.lists(st.sampled_from(PARTS), max_size=6).map("".join)
ROLES = st.one_of(st.sampled_from(["user", "assistant", "system", "end", "next"]), SPELLED)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(ROLES, SPELLED), min_size=1, max_size=7), min_size=8, max_size=25))
def test_any_text_comes_back(spark, chats):
    rows = [(c, k, r, t, "") for c, turns in enumerate(chats) for k, (r, t) in enumerate(turns)]
    made = chat.formatted(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digest(made).collect()}
    assert got == {
        c: wanted([(k, *x) for k, x in enumerate(turns)]) for c, turns in enumerate(chats)
    }


def test_same_roles_share_a_block(spark):
    rows = [(1, 0, "user", "a", ""), (1, 1, "user", "b", ""), (1, 2, "assistant", "c|>", "")]
    (row,) = chat.formatted(spark.createDataFrame(rows, SCHEMA)).collect()
    assert row.formatted == "<|role:user|>a<|next|>b<|end|><|role:assistant|>c|\\><|end|>"
    ((start, length),) = [tuple(x) for x in row.loss_spans]
    assert row.formatted[start : start + length] == "c|\\>"


def test_edges(spark):
    rows = [
        (1, None, "user", None, ""),
        (1, 1, None, "x", ""),
        (1, 1, "assistant", "tie", ""),
        (1, 1, "assistant", "tie", ""),
        (None, 0, "assistant", "no conversation", ""),
        (2, 0, "assistant", "long " * 100_000, ""),
        (3, 0, "assistant", None, ""),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digest(chat.formatted(df)).collect()}
    first = [(None, "user", ""), (1, "", "x"), (1, "assistant", "tie"), (1, "assistant", "tie")]
    assert got == {
        1: wanted(first),
        None: wanted([(0, "assistant", "no conversation")]),
        2: wanted([(0, "assistant", "long " * 100_000)]),
        3: wanted([(0, "assistant", "")]),
    }
    assert chat.digest(chat.formatted(df.limit(0))).count() == 0


def test_no_python_in_the_plan(spark):
    plan = chat.op4_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_many_turns(spark):
    """Twice the turns take about twice the time, where a square would take four times."""
    took = []
    for n in (20_000, 40_000):
        rows = spark.range(n).selectExpr(
            "1L AS conv_id", "id AS turn", "IF(id % 3 = 0, 'user', 'assistant') AS role", "concat('é<|', id) AS text"
        )
        begin = time.monotonic()
        row = chat.digest(chat.formatted(rows)).first()
        took.append(time.monotonic() - begin)
        texts = [f"é<|{i}" for i in range(n)]
        loss = "".join(x for i, x in enumerate(texts) if i % 3)
        assert (row.n_turns, row.loss_chars) == (n, len(loss))
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert took[1] < 60


def test_spans_in_code_points_and_bytes(spark):
    rows = spark.createDataFrame(
        [(1, i, "assistant" if i % 5 else "user", "é" * (i % 7) + "<|" * (i % 3)) for i in range(200)],
        "conv_id long, turn long, role string, text string",
    )
    row = chat.formatted(rows).first()
    wanted = [chat_escape("é" * (i % 7) + "<|" * (i % 3)) for i in range(200) if i % 5]
    data = row.formatted.encode()
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss_spans] == wanted
    assert [data[s.start : s.start + s.length].decode() for s in row.loss_bytes] == wanted


def chat_escape(text):
    for found, put in chat.ESCAPES:
        text = text.replace(found, put)
    return text
