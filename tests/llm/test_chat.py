"""Chat windows: read back, budgets, masks."""

import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillrun.llm import chat
from quillrun.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, window int, at_ string"


def said(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def read(df, **sizes):
    rows = chat.read_back(chat.chat_windows(df, **sizes)).collect()
    return {r.conv_id: ([tuple(t) for t in r.turns], r.learned) for r in rows}


CONTROL = st.lists(
    st.sampled_from(["</s>", "[INST]", "[/INST]", "<|end|>\n", "<|turn|>", "\\", "\n", "|", "<", "é😀", "a b"]),
    max_size=8,
).map("".join)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb%<|"]), CONTROL), min_size=1, max_size=9))
def test_any_text_comes_back(spark, turns):
    df = said(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])
    for sizes in ({}, {"budget": 24, "history": 12}):
        got, learned = read(df, **sizes)[1]
        assert got == turns and learned == "".join(t for r, t in turns if r == "assistant")


def test_windows_keep_to_the_budget(spark):
    turns = [("system", "be kind")] + [
        ("user" if i % 2 == 0 else "assistant", " ".join(f"w{i}" for _ in range(3 + i % 7))) for i in range(60)
    ]
    df = said(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])
    windows = chat.chat_windows(df, budget=100, history=30).orderBy("window").collect()
    assert len(windows) > 5
    cost = lambda text: len(re.findall(r"\w+|[^\w\s]", text)) + chat.TURN_TOKENS
    for at, w in enumerate(windows):
        parts = w.text.split(chat.END)[:-1]
        total = sum(cost(p.split("\n", 1)[1]) for p in parts)
        assert total <= 100
        assert parts[0].startswith("<|turn|>system\n") and (w.n_repeated > 0) == (at > 0)
        for s in w.loss:
            assert w.text[: s.start].count(chat.END) >= w.n_repeated


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None), (1, 0, "assistant", "x"), (1, 0, "assistant", "x"), (2, None, "user", ""),
        (None, 1, "assistant", "n"), (3, 0, "assistant", "long " * 30_000),
    ]
    found = read(said(spark, rows))
    assert found[1] == ([("", ""), ("assistant", "x"), ("assistant", "x")], "xx")
    assert found[2] == ([("user", "")], "") and found[None] == ([("assistant", "n")], "n")
    assert found[3][1] == "long " * 30_000
    assert chat.chat_windows(said(spark, [])).count() == 0


def test_query(spark, folder):
    plan = QUERIES["op9_chat_windows"](spark, folder)
    assert not re.search("Python|Pandas|InArrow", plan._jdf.queryExecution().toString())
    table = spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn")
    turns = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in table.collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    found = {r.conv_id: r for r in plan.collect()}
    assert found.keys() == turns.keys()
    for key, own in turns.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in own)
        loss = "".join(t for r, t in own if r == "assistant")
        r = found[key]
        assert (r.n_turns, r.loss_chars) == (len(own), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_escaping_leaves_no_marker(spark):
    text = "</s> <s> [INST] [/INST] <|x|> \\ <\\|"
    row = spark.range(1).select(chat.escaped(F.lit(text)).alias("e")).first()
    assert not re.search(r"</?s>|\[/?INST\]|<\|", row.e)
