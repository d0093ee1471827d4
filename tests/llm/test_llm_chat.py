"""Conversations in all layouts, odd records, and what no layout fits."""

import json

import pytest
from pyspark.sql import functions as F

from notegrove.llm import chat_format

TURNS = [("user", "How many?</s>\nTell <|im_end|>"), ("assistant", "Four. [INST]")]
(_, ASKED), (_, ANSWERED) = TURNS
# The same turns in every layout.
SAME = {
    "messages": {"messages": [{"role": r, "content": x} for r, x in TURNS]},
    "named": {"id": 5, "messages": [{"role": r, "content": x, "name": "n"} for r, x in TURNS], "score": {"a": [1]}},
    "parts": {"messages": [{"role": r, "content": [{"type": "text", "text": x[:3]}, {"type": "text", "text": x[3:]}]} for r, x in TURNS]},
    "untyped parts": {"messages": [{"role": r, "content": [{"text": x}]} for r, x in TURNS]},
    "mixed": {"messages": [{"role": "user", "content": ASKED}, {"role": "assistant", "content": [{"type": "text", "text": ANSWERED}, {"type": "image", "url": "u"}]}]},
    "from": {"conversations": [{"from": r, "value": x} for r, x in (("human", ASKED), ("gpt", ANSWERED))]},
    "completion": {"prompt": ASKED, "completion": ANSWERED},
    "with id": {"id": "x", "prompt": ASKED, "completion": ANSWERED},
    "response": {"prompt": ASKED, "response": ANSWERED, "system": None},
    "instruction": {"instruction": ASKED, "output": ANSWERED},
    "input": {"instruction": ASKED, "input": "", "output": ANSWERED, "system": ""},
}
ROWS = [{"turn": k, "role": r, "text": x} for k, (r, x) in enumerate(TURNS)]


def records_of(spark, values):
    rows = [(k, json.dumps(x)) for k, x in values]
    return spark.createDataFrame(rows, "conv_id long, json string").select("conv_id", F.parse_json("json").alias("record"))


def digests(spark, values):
    turns = chat_format.canonical(records_of(spark, values), "conv_id", "record")
    return {r.conv_id: r for r in chat_format.read_back(chat_format.write_segments(turns)).collect()}


def test_all_layouts_give_equal_digests(spark):
    values = [(k, x) for k, x in enumerate(SAME.values())] + [(99, x) for x in ROWS]
    got = digests(spark, values)
    assert got.keys() == {k for k, _ in values}
    assert len({tuple(r)[1:] for r in got.values()}) == 1
    assert got[99].n_turns == 2 and got[99].loss_chars == len(ANSWERED)
    used = {r.layout for r in chat_format.by_layout(records_of(spark, values), "record").collect()}
    empty = {k for k, t in enumerate(chat_format.LAYOUTS) if t.paths in (("messages[]",), ("conversations[]",))}
    assert used == set(range(len(chat_format.LAYOUTS))) - empty


def test_optional_fields_become_turns(spark):
    value = {"instruction": "Add.", "input": "1 2", "output": None, "system": "Be short."}
    turns = chat_format.canonical(records_of(spark, [(1, value)]), "conv_id", "record").orderBy("turn").collect()
    assert [(t.role, t.text) for t in turns] == [("system", "Be short."), ("user", "Add."), ("user", "1 2"), ("assistant", "")]


@pytest.mark.parametrize(
    "value",
    [{"messages": None}, {"messages": "text"}, {"prompt": "a"}, {"prompt": "a", "completion": "b", "response": "c"}, {"messages": [{"role": "user"}]}, {}, [], "text", None, [{"role": "user", "content": "a"}]],
)
def test_records_without_a_layout_are_returned(spark, value):
    records = records_of(spark, [(1, value), (2, SAME["messages"])])
    assert [r.conv_id for r in chat_format.unmapped(records, "record").collect()] == [1]
    assert {r.layout: r.n for r in chat_format.by_layout(records, "record").collect()} == {None: 1, 1: 1}
    assert digests(spark, [(1, value), (2, SAME["messages"])]).keys() == {2}


def test_empty_lists_are_known_and_give_no_turn(spark):
    records = records_of(spark, [(1, {"messages": []}), (2, {"conversations": [], "id": 1})])
    assert chat_format.unmapped(records, "record").count() == 0
    assert chat_format.canonical(records, "conv_id", "record").count() == 0


def test_every_fingerprint_has_one_layout():
    told = [chat_format.fingerprints_of(t) for t in chat_format.LAYOUTS]
    assert all(len(set(keys)) == len(keys) for keys in told)
