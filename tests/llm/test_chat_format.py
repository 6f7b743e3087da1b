from __future__ import annotations

import json
import random

import pytest

from footfall.llm import chat_format
from tests.llm.conftest import SF

TALK = "conv_id long, turn long, role string, text string"


def call(*calls):
    return json.dumps({"tool_calls": list(calls)})


def test_given_conversations(spark):
    talk = spark.read.parquet(f"{SF}/conversations.parquet")
    given = {(r["conv_id"], r["turn"]): r for r in talk.collect()}
    out = chat_format.format_calls(talk).collect()
    assert len(out) == len(given)
    for r in out:
        turn = given[r["conv_id"], r["turn"]]
        value = json.loads(r["json"])
        assert r["json"] == json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        if turn["role"] == "assistant":
            before = given.get((r["conv_id"], r["turn"] - 1))
            assert r["kind"] == "result" and value["content"] == turn["text"] and r["linked"] == (before is not None and before["role"] != "assistant")
        else:
            after = given.get((r["conv_id"], r["turn"] + 1))
            assert r["kind"] == "call" and value["arguments"] == {"prompt": turn["text"], "role": turn["role"]} and r["n_errors"] == 0
            assert r["linked"] == (after is not None and after["role"] == "assistant")


def test_explicit_calls(spark):
    rows = [
        (1, 0, "user", "weather?"),
        (1, 1, "assistant", call({"id": "a", "name": "weather", "arguments": {"unit": "C", "city": "Köln", "days": 2}}, {"id": "b", "name": "weather", "arguments": {"city": 5, "x": None}})),
        (1, 2, "tool", '{"tool_call_id": "b", "content": {"z": 1, "a": [true, null]}}'),
        (1, 3, "tool", '{"tool_call_id": "a", "content": "ok"}'),
        (1, 4, "tool", '{"tool_call_id": "lost", "content": 1}'),
        (1, 5, "assistant", call({"id": "c", "name": "unknown", "arguments": {}})),
        (1, 6, "user", '{"not": "a call"'),
    ]
    schemas = spark.createDataFrame(
        [("weather", "city", "STRING", True), ("weather", "unit", "STRING", False), ("weather", "days", "NUMBER", False)], "tool string, field string, type string, required boolean"
    )
    out = {(r["kind"], r["call_id"]): r for r in chat_format.format_calls(spark.createDataFrame(rows, TALK), schemas).collect()}
    assert out["call", "a"]["json"] == '{"arguments":{"city":"Köln","days":2,"unit":"C"},"id":"a","kind":"call","name":"weather"}'
    assert (out["call", "a"]["n_errors"], out["call", "b"]["n_errors"], out["call", "c"]["n_errors"]) == (0, 2, 1)
    assert out["result", "b"]["json"] == '{"content":{"a":[true,null],"z":1},"id":"b","kind":"result"}'
    assert out["call", "a"]["linked"] and out["result", "a"]["linked"]
    assert not out["call", "c"]["linked"] and not out["result", "lost"]["linked"]
    assert ("call", "1:6") in out


def test_topological_order(spark):
    """Results may come early, calls may wait for results that come late; cycles have no place."""
    one = lambda name, *after: call({"id": name, "name": "t", "arguments": {}, "after": list(after)})
    done = lambda name: json.dumps({"tool_call_id": name, "content": 0})
    rows = [
        (1, 0, "assistant", one("a", "b")), (1, 1, "assistant", one("b", "c")), (1, 2, "assistant", one("c")),
        (1, 3, "tool", done("b")), (1, 4, "tool", done("a")), (1, 9, "tool", done("c")),
        (2, 5, "assistant", one("d")), (2, 4, "tool", done("d")),
        (3, 0, "assistant", one("x", "y")), (3, 1, "assistant", one("y", "x")), (3, 2, "assistant", one("z")),
    ]
    out = chat_format.format_calls(spark.createDataFrame(rows, TALK)).collect()
    at = {(r["kind"], r["call_id"]): (r["order_turn"], r["phase"]) for r in out}
    chain = [("call", "c"), ("result", "c"), ("call", "b"), ("result", "b"), ("call", "a"), ("result", "a")]
    assert sorted(chain, key=at.__getitem__) == chain
    assert at["call", "d"] < at["result", "d"]
    assert at["call", "x"][0] is None and at["call", "y"][0] is None and at["call", "z"][0] == 2


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """Chains of a thousand calls, of which some name several before them: a dozen rounds each."""
    n = 1000
    one = lambda k, after: call({"id": f"c{k}", "name": "t", "arguments": {}, "after": after})
    rows = [(1, n - k, "assistant", one(k, [f"c{k - 1}"] if k else [])) for k in range(n)]
    rows += [(2, k, "assistant", one(k, [f"c{j}" for j in range(max(0, k - 3), k)])) for k in range(n)]
    rounds = []
    stored = chat_format.stored
    monkeypatch.setattr(chat_format, "stored", lambda df, name: (rounds.append(name), stored(df, name))[1])
    out = chat_format.format_calls(spark.createDataFrame(rows, TALK))
    at = {(r["conv_id"], r["call_id"]): r["order_turn"] for r in out.collect()}
    assert all(at[1, f"c{k}"] == n + k and at[2, f"c{k}"] == k for k in range(n))
    assert rounds.count("chains") <= 13


@pytest.mark.parametrize("seed", range(3))
def test_order_of_random_references(spark, seed):
    """Against plain relaxation; cycles, references to nothing and to themselves among them."""
    pick = random.Random(seed)
    rows, after, own, result = [], {}, {}, {}
    for conv in range(6):
        n = 14
        for k in range(n):
            backward = [j for j in range(n) if j != k] if conv == 0 else list(range(k)) + ([k + 1] if pick.random() < 0.08 else [])
            refs = pick.sample(backward, min(len(backward), pick.choice((0, 1, 1, 2, 3)))) + ([99] if pick.random() < 0.1 else []) + ([k] if pick.random() < 0.03 else [])
            own[conv, k] = result[conv, k] = pick.randint(0, 50)
            after[conv, k] = refs
            body = {"id": str(k), "name": "t", "arguments": {}, "after": [str(r) for r in refs]}
            rows.append((conv, own[conv, k], "assistant", call(body)))
            if pick.random() < 0.6:
                late = pick.randint(0, 60)
                result[conv, k] = max(own[conv, k], late)
                rows.append((conv, late, "tool", json.dumps({"tool_call_id": str(k), "content": 0})))
    at = dict(own)
    for _ in range(500):
        for (c, k), refs in after.items():
            for r in refs:
                if (c, r) in at:
                    at[c, k] = max(at[c, k], max(at[c, r], result[c, r]) + 1)
    want = {key: v if v < 200 else None for key, v in at.items()}
    assert None in want.values()
    out = chat_format.format_calls(spark.createDataFrame(rows, TALK)).where("kind = 'call'").collect()
    assert {(r["conv_id"], int(r["call_id"])): r["order_turn"] for r in out} == want


def test_empty_lists_and_mixed_messages(spark):
    """No turn vanishes: an empty list is a plain turn, a message may be calls and a result, words beside calls stay."""
    one = {"id": "a", "name": "t", "arguments": {}}
    rows = [
        (1, 0, "user", '{"tool_calls": []}'),
        (1, 1, "assistant", json.dumps({"tool_calls": [one], "content": "let me see"})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": 5, "tool_calls": [{**one, "id": "b"}]})),
        (1, 3, "tool", '{"tool_calls": [], "tool_call_id": "b", "content": "ok"}'),
        (1, 4, "assistant", json.dumps({"tool_calls": [{**one, "id": "c"}], "content": None})),
        (1, 5, "user", json.dumps({"tool_calls": [{**one, "id": "d"}], "content": ["x"]})),
    ]
    out = chat_format.format_calls(spark.createDataFrame(rows, TALK)).collect()
    by = {(r["turn"], r["kind"], r["call_id"]): r for r in out}
    assert len(out) == 9 and set(by) == {
        (0, "call", "1:0"), (1, "call", "a"), (1, "result", "1:0"), (2, "call", "b"), (2, "result", "a"), (3, "result", "b"), (4, "call", "c"), (5, "call", "d"), (5, "call", "1:5"),
    }
    assert json.loads(by[0, "call", "1:0"]["json"])["arguments"]["prompt"] == '{"tool_calls": []}'
    assert by[1, "result", "1:0"]["json"] == '{"content":"let me see","id":"1:0","kind":"result"}' and by[1, "result", "1:0"]["linked"]
    assert by[2, "result", "a"]["json"] == '{"content":5,"id":"a","kind":"result"}' and by[2, "result", "a"]["linked"]
    assert by[3, "result", "b"]["linked"] and by[1, "call", "a"]["linked"]
    assert json.loads(by[5, "call", "1:5"]["json"])["arguments"] == {"prompt": ["x"], "role": "user"} and by[5, "call", "1:5"]["n_errors"] == 1


def test_ids_hold_within_their_conversation(spark):
    """Equal ids of two conversations are not linked, and `after` does not reach into another conversation."""
    one = lambda name, *after: call({"id": name, "name": "t", "arguments": {}, "after": list(after)})
    done = lambda name: json.dumps({"tool_call_id": name, "content": 0})
    rows = [
        (1, 0, "assistant", one("x")), (1, 9, "tool", done("x")), (1, 1, "assistant", one("y", "x")),
        (2, 0, "assistant", one("x")), (2, 1, "assistant", one("y", "x")), (2, 7, "tool", done("z")),
        (3, 0, "assistant", one("z")),
        *[(10 + k, 0, "assistant", one(f"k{k}", f"k{k + 1}")) for k in range(4)],
        (None, 0, "assistant", one("x")), (None, 3, "tool", done("x")), (None, 5, "assistant", one("y", "x")),
    ]
    out = chat_format.format_calls(spark.createDataFrame(rows, TALK)).collect()
    at = {(r["conv_id"], r["kind"], r["call_id"]): (r["linked"], r["order_turn"]) for r in out}
    assert len(out) == len(rows)
    assert at[1, "call", "x"] == (True, 0) and at[1, "result", "x"] == (True, 9) and at[1, "call", "y"] == (False, 10)
    assert at[2, "call", "x"] == (False, 0) and at[2, "call", "y"] == (False, 1)
    assert at[3, "call", "z"] == (False, 0) and at[2, "result", "z"] == (False, 7)
    assert [at[10 + k, "call", f"k{k}"] for k in range(4)] == [(False, 0)] * 4
    assert at[None, "call", "x"] == (False, 0) and at[None, "result", "x"] == (False, 3) and at[None, "call", "y"] == (False, 5)


def test_nulls_repeats_and_empty(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, None, "user", "x"), (None, 2, "assistant", "y"), (2, 0, None, None), (2, 1, "assistant", "")]
    df = spark.createDataFrame(rows, TALK).selectExpr("*", "'q' as kind", "'r' as call_id", "1 as phase")
    out = chat_format.format_calls(df).collect()
    assert len(out) == len(rows)
    by = {(r["conv_id"], r["turn"]): r for r in out}
    assert by[1, 1]["json"] == '{"content":null,"id":"1:0","kind":"result"}' and by[1, 1]["linked"]
    assert by[1, None]["call_id"] is None and not by[1, None]["linked"] and not by[None, 2]["linked"]
    assert by[2, 0]["n_errors"] == 2 and by[2, 0]["linked"]
    assert chat_format.format_calls(spark.createDataFrame([], TALK)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = chat_format.format_calls(spark.read.parquet(f"{SF}/conversations.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
