from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from footfall.llm import prefix_trie

SF = "/root/testdata/sf0.01"
KINDS = "conv_id long, turn long, role string, text string"


def sequences(rows):
    by = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(turns)] for c, turns in by.items()}


def rebuilt(by):
    out = {}
    for c, turns in by.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(c - 20 * int(c / 20))
        out[c] = by.get(base, [])[:h] + turns[h:]
    return out


def brute(by):
    """Every node from all conversations that begin with it."""
    if not by:
        return []
    nodes = {}
    for c, turns in by.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for key in nodes:
        if key:
            children.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(nodes, key=len, reverse=True):
        below = children.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        saved[key] = sum(saved[k] for k in below) + (len(nodes[key]) - 1) * words
    out = []
    for key, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(by[c]) == len(key))))
        parent = min(nodes[key[:-1]]) if key else None
        row = (min(members), len(key), parent, len(members), len(children.get(key, [])), leaves[key], saved[key])
        out.append((*row, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/conversations.parquet")


def test_given_conversations(given):
    assert got(prefix_trie.report(given)) == brute(rebuilt(sequences(map(tuple, given.select("conv_id", "turn", "role", "text").collect()))))


@pytest.fixture(scope="module")
def odd():
    """Copies, shared beginnings, ties, nulls, repeated rows, long conversations, ids without a base."""
    pick, rows = random.Random(13), []
    for c in range(-45, 400):
        if c % 20 == 0 and pick.random() < 0.3:
            continue
        n = pick.choice((1, 1, 2, 3, 4, 5, 9))
        kind = pick.random()
        for k in range(n):
            text = f"t{k} of {pick.randint(0, 1)}  words\there" if kind < 0.6 else "the same" if kind < 0.8 else pick.choice((None, "", " ", "y\x00z"))
            rows.append((c, None if pick.random() < 0.05 else pick.choice((k, k, k, 0)), pick.choice(("u", "a", None)) if kind > 0.9 else "u", text))
    rows += rows[:40]
    rows += [(None, 1, "u", "nobody's")] * 5
    for c in (1000, 1001, 1002, 1004, 1007):
        rows += [(c, k, "u", f"turn {k % 7}") for k in range(300 if c < 1004 else 64 if c < 1005 else 131)]
    rows += [(1003, k, "u", f"turn {k % 7}" if k < 250 else "else") for k in range(290)]
    pick.shuffle(rows)
    return rows


def test_odd_rows(spark, odd):
    df = spark.createDataFrame(odd, KINDS).selectExpr("*", "'x' as key", "1 as place", "2 as conv", "3 as n")
    assert got(prefix_trie.report(df)) == brute(rebuilt(sequences(odd)))
    assert got(prefix_trie.trie(df)) == brute(sequences(odd))


def test_many_small_shards(spark, odd, monkeypatch):
    """Runs of a few turns and short segments: nearly all nodes are merged, and segments hang four levels deep."""
    monkeypatch.setattr(prefix_trie, "RUN", 9)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "SEGMENT", 4)
    short = [r for r in odd if r[0] is None or r[0] < 400 or r[1] < 40]
    assert got(prefix_trie.report(spark.createDataFrame(short, KINDS).repartition(7))) == brute(rebuilt(sequences(short)))


def test_copies_of_one_conversation_fill_many_shards(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 50)
    rows = [(20 * c, k, "u", f"turn {k}") for c in range(700) for k in range(3)]
    out = got(prefix_trie.trie(spark.createDataFrame(rows, KINDS)))
    assert out == brute(sequences(rows)) and len(out) == 4


def test_empty_and_without_ids(spark):
    assert prefix_trie.report(spark.createDataFrame([], KINDS)).collect() == []
    assert prefix_trie.report(spark.createDataFrame([(None, 1, "u", "x")], KINDS)).collect() == []
    lone = [(7, 1, "u", "a b")]  # its first turns are taken from a conversation that is not there
    assert got(prefix_trie.report(spark.createDataFrame(lone, KINDS))) == brute(rebuilt(sequences(lone)))


def test_search_tree_is_balanced():
    tree = prefix_trie._Tree()
    for k in prefix_trie._median_first(1023):
        tree.insert([k], k)
    depth, level = 0, [tree.next[0]]
    while level:
        depth, level = depth + 1, [x for at in level for x in (tree.low[at], tree.high[at]) if x]
    assert depth == 10
    assert sorted(turn for turn, *_ in tree.walk()) == list(range(-1, 1023))
