from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from perkline.llm import chat

PIECES = ["<|im_end|>\n", "<|im_start|>", "<|im_sep|>", "<|nl|>", "<", "|", "\\", "<\\|", "<\\\\|", "\n", "é", "assistant", " ok ", "", "$1"]


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(12)
    text = lambda: None if rng.random() < 0.05 else "".join(rng.choice(PIECES) for _ in range(rng.randrange(9)))
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", None, "odd\n<|x|>role"]), text()))
    rows += [(100, i, "user" if i % 3 else "assistant", f"turn {i}") for i in range(2000)]
    rows += [(101, 1, "user", "same"), (101, 1, "user", "same"), (101, None, "assistant", "first"), (None, 2, "assistant", "no id")]
    return rows


def test_round_trip(session, turns):
    schema = "conv_id long, turn long, role string, text string, said string, segments int"
    df = session.createDataFrame([(*r, "clash", 1) for r in turns], schema).repartition(5)
    out = chat.format_chats(df).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned"), "segments"
    )
    want = defaultdict(list)
    for conv, turn, role, text in turns:
        want[conv].append((turn is not None, turn or 0, role or "", text or ""))
    rows = out.collect()
    assert len(rows) == len(want)
    for r in rows:
        expected = sorted(want[r["conv_id"]])
        got = [(t["role"], t["text"]) for t in r["turns"]]
        assert [g[0] for g in got] == [e[2] for e in expected]
        assert sorted(got) == sorted((e[2], e[3]) for e in expected)
        assert r["learned"] == "".join(text for role, text in got if role == "assistant")
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])


def test_neighbours_of_one_role_are_merged(session):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "<|im_end|>")]
    out = chat.format_chats(session.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert out["formatted"] == (
        "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_sep|><\\|im_end|><|im_end|>\n"
    )
    assert [s["text"] for s in out["segments"] if s["loss"]] == ["c", "<\\|im_end|>"]


def test_no_rows_and_no_python(session):
    empty = chat.format_chats(session.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert empty.count() == 0
    plan = empty._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
