"""Chat formatting: layouts, exact round trips, masks."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granero.llm import chat

TRICKY = st.lists(st.one_of(st.sampled_from(["\\", "###", "#", "</turn>", "<", "\n", ": ", "### user: ", "\\\\", "</turn>\n### assistant: "]), st.text(max_size=5)), max_size=8).map("".join)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), TRICKY), TRICKY), max_size=6))
@settings(max_examples=500, deadline=None)
def test_round_trip(turns):
    text, loss = chat.write_turns(turns)
    assert chat.read_turns(text) == turns
    assert [chat.unescape(text[s : s + n]) for s, n in loss] == [body for role, body in turns if role == "assistant"]


def test_a_long_text_reads_back():
    turns = [("user", "x<\\" * 300_000), ("assistant", "### </turn>" * 100_000)]
    assert chat.read_turns(chat.write_turns(turns)[0]) == turns


def test_damaged_text_is_refused():
    with pytest.raises(ValueError):
        chat.read_turns("### user: no end")


SCHEMA = "conv_id long, turn long, role string, text string, turns int, formatted string"


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (2, None, None, "a"), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"),
        (None, 0, "user", "x"), (None, 1, "assistant", "y"), (3, 0, "assistant", "é😀" * 5000), (4, 0, "a:b", "### </turn> \\"),
    ]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA).repartition(3)
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(chat.canonical_turns(df))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv))
        learned = "".join(text for _, role, text in own if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{role}\n{text}\n" for _, role, text in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), sha(learned))
    assert len(got) == 5
    nothing = chat.read_back(chat.format_conversations(chat.canonical_turns(df.limit(0))))
    assert nothing.count() == 0


def turns_of(df):
    return sorted((r.turn, r.role, r.text) for r in df.collect())


def test_layouts_of_tables(spark):
    messages = spark.createDataFrame([([("human", "q"), ("gpt", "a")],)], "conversations array<struct<from:string,value:string>>")
    assert chat.mapping_of(messages).name == "conversations"
    assert turns_of(chat.canonical_turns(messages)) == [(0, "user", "q"), (1, "assistant", "a")]
    fields = spark.createDataFrame([("do", "", "done", 1)], "instruction string, input string, output string, score int")
    assert chat.mapping_of(fields).name == "instruction with input"
    assert turns_of(chat.canonical_turns(fields)) == [(0, "user", "do"), (1, "assistant", "done")]
    nested = spark.createDataFrame([(("p", "r"),)], "data struct<prompt:string,response:string>")
    assert turns_of(chat.canonical_turns(nested)) == [(0, "user", "p"), (1, "assistant", "r")]
    with pytest.raises(ValueError):
        chat.mapping_of(spark.createDataFrame([(1,)], "other int"))


def test_json_records_of_mixed_layouts(spark):
    records = [
        (1, json.dumps({"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]})),
        (2, json.dumps({"response": "r", "prompt": "p"})), (3, json.dumps({"unknown": 1})), (4, "no json"), (5, None),
        (6, json.dumps({"conversations": [{"from": "human", "value": "x"}]})), (7, json.dumps({"data": {"prompt": "p", "response": None}})), (8, "[1]"),
    ]
    got = chat.json_turns(spark.createDataFrame(records, "id long, raw string"), "id", "raw").collect()
    rows = sorted((r.conv_id, r.layout or "", -1 if r.turn is None else r.turn, r.role or "", r.text or "") for r in got)
    assert rows == [
        (1, "messages", 0, "user", "q"), (1, "messages", 1, "assistant", "a"), (2, "prompt and response", 0, "user", "p"),
        (2, "prompt and response", 1, "assistant", "r"), (3, "", -1, "", '{"unknown": 1}'), (4, "", -1, "", "no json"), (5, "", -1, "", ""),
        (6, "conversations", 0, "user", "x"), (7, "nested turn", 0, "user", "p"), (8, "", -1, "", "[1]"),
    ]


def test_fingerprints_do_not_depend_on_order_and_tell_layouts_apart():
    assert chat.fingerprint(["b", "a"]) == chat.fingerprint(["a", "b", "a"])
    assert len(chat.BY_FINGERPRINT) == len(chat.MAPPINGS)
