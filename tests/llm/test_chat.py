import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm.chat import conversations, escape, linear_threads, paths, read_back, render, unescape
from shelfwise.llm.queries import op1_chat

ODD = st.text(st.sampled_from("#\\</turn>: \n" + "aé"), max_size=30)
MSG = "message_id string, parent_id string, role string, text string, score double, junk int"


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(ODD, ODD), max_size=5))
def test_round_trip(turns):
    text, starts, ends = render(turns, learn="a")
    assert read_back(text) == turns
    learned = [unescape(text[a:b]) for a, b in zip(starts, ends)]
    assert learned == [t for r, t in turns if r == "a"]
    assert text.count("</turn>") == len(turns)


@given(ODD)
def test_escaped_text_has_no_control_string(text):
    assert "###" not in escape(text) and "</turn>" not in escape(text)


def test_best_branches(spark):
    rows = [("r", None, "user", "q", 0.0, 1), ("a", "r", "assistant", "A", 1.0, 1), ("b", "r", "assistant", "B", 4.0, 1),
            ("c", "a", "user", "C", 9.0, 1), ("d", "b", "user", "D", 0.0, 1), ("e", "b", "user", "E", 0.0, 1),
            ("lone", "missing", "user", None, None, 1),
            ("x", "y", "user", "loop", 1.0, 1), ("y", "x", "user", "loop", 1.0, 1),
            ("d", "b", "user", "D", 0.0, 1), (None, "r", "user", "no id", 1.0, 1)]
    messages = spark.createDataFrame(rows, MSG)
    got = {(r.root_id, r.rank): (r.leaf_id, r.formatted) for r in conversations(messages, keep=2).collect()}
    assert {k: v[0] for k, v in got.items()} == {("r", 1): "c", ("r", 2): "d", ("lone", 1): "lone"}
    assert read_back(got["r", 1][1]) == [("user", "q"), ("assistant", "A"), ("user", "C")]
    assert read_back(got["lone", 1][1]) == [("user", "")]
    every = paths(messages.select("message_id", "parent_id", "score"), keep=None)
    assert {r.leaf_id for r in every.collect()} == {"c", "d", "e", "lone"}


def test_long_chain_and_empty(spark):
    rows = [(f"m{i}", f"m{i - 1}" if i else None, "user", str(i), 0.0, 1) for i in range(37)]
    messages = spark.createDataFrame(rows, MSG)
    one = conversations(messages).collect()
    assert len(one) == 1 and read_back(one[0].formatted) == [("user", str(i)) for i in range(37)]
    assert conversations(messages.limit(0)).count() == 0


def test_threads_of_odd_rows(spark):
    turns = spark.createDataFrame([(None, 0, "user", "n"), (None, 1, "assistant", None), (3, None, "user", "first"),
                                   (3, 2, "user", "b"), (3, 2, "user", "a"), (3, 2, "user", "a"), (4, 0, None, "")],
                                  "conv_id long, turn long, role string, text string")
    got = {r.leaf_id.split(":")[0]: read_back(r.formatted) for r in conversations(linear_threads(turns)).collect()}
    assert got == {"none": [("user", "n"), ("assistant", "")], "4": [("", "")],
                   "3": [("user", "first"), ("user", "a"), ("user", "a"), ("user", "b")]}


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    said = "\\### Assistant: </turn> ok"
    expected = {-7: [("user", said), ("assistant", said)]}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        expected.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = {r.conv_id: r for r in op1_chat(spark, sf_dir).collect()}
    assert set(got) == set(expected)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv_id, turns in expected.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[conv_id].n_turns, got[conv_id].turns_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (got[conv_id].loss_chars, got[conv_id].loss_sha256) == (len(loss), sha(loss))


def test_very_long_texts(spark):
    """Whole texts are formatted and read back, control strings and all."""
    texts = ["### a: </turn>\\ " * 40_000, "é#" * 300_000]
    rows = [(1, 0, "user", texts[0]), (1, 1, "assistant", texts[1])]
    turns = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, _m int")
    done = conversations(linear_threads(turns)).collect()
    assert [read_back(r.formatted) for r in done] == [[("user", texts[0]), ("assistant", texts[1])]]
    assert unescape(done[0].formatted[done[0].loss_starts[0]:done[0].loss_ends[0]]) == texts[1]
