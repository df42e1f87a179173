import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanforge.llm import chat, queries

TRICKY = "\\### Assistant: </turn> ok"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "User", "a: b", "Role=x", "### "]) | st.text(max_size=5), st.text(alphabet="\\#< /turn>:\nAé", max_size=30) | st.just(TRICKY)), max_size=5))
def test_round_trip(turns):
    assert chat.read_turns("".join(chat.write_turn(r, t)[0] for r, t in turns)) == turns


def test_mask_covers_the_assistant():
    w, at, n = chat.write_turn("assistant", TRICKY)
    assert chat.unescape(w[at : at + n]) == TRICKY and "### Assistant" in w[:at] and w[at:].count("</turn>") == 2
    assert chat.write_turn("user", TRICKY)[2] == 0
    with pytest.raises(ValueError):
        chat.read_turns("### User: a</turn>\nb")


@pytest.mark.parametrize(
    "record, turns",
    [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 5}, [("user", "a"), ("assistant", "b")]),
        ({"system": "s", "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]}, [("system", "s"), ("user", "a"), ("assistant", "")]),
        ({"instruction": "i", "input": None, "output": "o"}, [("user", "i"), ("assistant", "o")]),
        ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
        ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
        ({"data": {"question": "q", "answer": "a"}, "meta": {"n": [1, True]}}, [("user", "q"), ("assistant", "a")]),
        ({"prompt": "p", "completion": "c", "messages": [{"role": "user", "content": "a"}]}, []),
        ({"prompt": 5, "completion": "c"}, []),
        ({"messages": []}, []),
        ([1], []),
    ],
)
def test_layouts(record, turns):
    assert chat.turns_of(record)[1] == turns


def test_layouts_have_fingerprints_of_their_own():
    forms = [f for x in chat.LAYOUTS for f in x.fingerprints()]
    assert len(forms) == len(set(forms)) == len(chat.BY_FINGERPRINT)


def plain(turns):
    t = "".join(f"{r}\n{x}\n" for r, x in turns)
    loss = "".join(x for r, x in turns if r == "assistant")
    sha = [hashlib.sha256(v.encode()).hexdigest() for v in (t, loss)]
    return len(turns), sha[0], len(loss), sha[1], sum(len(chat.write_turn(r, x)[0]) for r, x in turns)


def test_digests(spark):
    rows = [(1, 1, "assistant", "b é"), (1, 0, "user", "a"), (1, 2, None, None), (2, 0, "assistant", TRICKY * 3000), (2, 0, "assistant", "same turn"), (None, 5, "user", "x"), (1, None, "system", "first")]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, written string, n_turns int")
    got = {r.conv_id: tuple(r)[1:] for r in chat.digests(chat.write_turns(chat.turn_rows(df))).collect()}
    two = sorted([("assistant", TRICKY * 3000), ("assistant", "same turn")], key=lambda x: chat.write_turn(*x)[0])
    assert got == {1: plain([("system", "first"), ("user", "a"), ("assistant", "b é"), ("", "")]), 2: plain(two), None: plain([("user", "x")])}
    assert chat.digests(chat.write_turns(chat.turn_rows(df.limit(0)))).count() == 0
    whole = {r.conv_id: r for r in chat.conversations(chat.write_turns(chat.turn_rows(df))).collect()}
    assert chat.read_turns(whole[1].text)[2] == ("assistant", "b é")
    assert [chat.unescape(whole[1].text[m.start : m.start + m.length]) for m in whole[1].masks] == ["b é"]


def test_records_of_many_layouts(spark):
    records = [(1, json.dumps({"prompt": "p", "completion": "c"})), (2, "{broken"), (3, None), (4, json.dumps({"messages": [{"role": "user", "content": "m"}]}))]
    got = chat.canonical_turns(spark.createDataFrame(records, "conv_id long, record string")).collect()
    assert sorted((r.conv_id, r.turn or 0, r.role or "", r.text or "", r.layout or "") for r in got) == [
        (1, 0, "user", "p", "prompt and completion"), (1, 1, "assistant", "c", "prompt and completion"), (2, 0, "", "", ""), (3, 0, "", "", ""), (4, 0, "user", "m", "messages"),
    ]
    typed = spark.createDataFrame([(7, [("user", "a"), ("assistant", "b")], 1)], "conv_id long, messages array<struct<role string, content string>>, n int")
    assert sorted(tuple(r) for r in chat.turn_rows(typed).collect()) == [(7, 0, "user", "a"), (7, 1, "assistant", "b")]
    with pytest.raises(ValueError):
        chat.turn_rows(spark.createDataFrame([(1, "x")], "conv_id long, other string"))


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    turns = {-7: [("user", TRICKY), ("assistant", TRICKY)]}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert {r.conv_id: tuple(r)[1:] for r in queries.op9_chat_format(spark, sf).collect()} == {k: plain(v) for k, v in turns.items()}
