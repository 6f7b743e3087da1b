from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from footfall.llm import collocations

SF = "/root/testdata/sf0.01"
A_Z = {c: c + 32 for c in range(65, 91)}


def brute(rows, top=2000):
    """rows: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_Z)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(words)
            for size in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        found = []
        for phrase, a in counts.items():
            if len(phrase) == 1 or a < 10:
                continue
            cuts = [(1000000 * a * a // (counts[phrase[:k]] * counts[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((score, a, " ".join(phrase), counts[phrase[:k]], counts[phrase[k:]]))
        inside = {" ".join(p[i : i + 2]) for p, a in counts.items() if len(p) == 3 and a >= 10 for i in (0, 1) if 100 * a >= 50 * counts[p[i : i + 2]]}
        found = sorted((x for x in found if x[2] not in inside), key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, k + 1, p, a, left, right, n[lang], score) for k, (score, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def odd_texts():
    pick, rows = random.Random(11), []
    words = [f"w{k}" for k in range(60)] + ["Ünit", "ünit", "A-b", "x\x00y", "日本", "e f", "a\xa0b"]
    for k in range(500):
        text = "".join(pick.choice(words[: pick.choice((6, 20, 67))]) + pick.choice((" ", " ", "  ", "\t", ". ", "\n", "!?")) for _ in range(pick.randint(0, 60)))
        rows.append((pick.choice(("en", "en", "de", None, "und", "")), text + pick.choice(("", " New York City", " NEW york town, new YORK"))))
    return rows + [("en", None), (None, ""), ("de", " \t\n. ,"), ("en", "one two " * 30_000)] + rows[:30]


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(collocations.report(docs)) == brute([(r["lang"], r["text"]) for r in docs.collect()])


def test_odd_texts_over_many_tries(spark, odd_texts, monkeypatch):
    """Small tries, one after the other, and a full bitmap that prunes little."""
    monkeypatch.setattr(collocations, "SHARD", 150)
    monkeypatch.setattr(collocations, "TRIES", 2)
    monkeypatch.setattr(collocations, "BITS", 8)
    df = spark.createDataFrame([(k, *r, 1) for k, r in enumerate(odd_texts)], "doc_id long, lang string, text string, phrase int").repartition(5)
    want = brute(odd_texts)
    assert got(collocations.report(df)) == want and len(want) > 100
    assert got(collocations.report(df, 3)) == brute(odd_texts, 3)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert collocations.report(none).collect() == []
    assert collocations.report(spark.createDataFrame([(1, None, None), (2, "en", "a b")], none.schema)).collect() == []


def test_double_array_holds_exactly_its_rows():
    pick = random.Random(5)
    rows = {(pick.randint(1, 3), *(pick.randint(4, 400) for _ in range(pick.choice((1, 2, 3))))) for _ in range(20_000)}
    rows = sorted(rows)
    symbols = np.zeros((len(rows), 4), np.int64)  # a language and three words of one symbol each
    for k, r in enumerate(rows):
        symbols[k, : len(r)] = r
    base, check, accept = collocations.double_array(symbols)
    trie = collocations.Trie(None, None, None, None, base, check, accept)

    def find(r):
        state = np.array([1])
        for s in r:
            state = trie.step(state, np.array([s]))
        return int(accept[state[0]]) if state[0] else -1

    assert [find(r) for r in rows[::7]] == list(range(0, len(rows), 7))
    strange = [tuple(pick.randint(1, 400) for _ in range(4)) for _ in range(3000)]
    assert all(find(r) == -1 for r in strange if r not in set(rows))
    assert len(check) < 4 * len(rows)


def test_exact_beyond_64_bits(spark):
    rows = [("en", w, 1, f) for w, f in (("a", 10**13), ("b", 2 * 10**13), ("c", 10**12))]
    rows += [("en", "a b", 2, 10**13 - 7), ("en", "b c", 2, 10**12 - 1), ("en", "a b c", 3, 10**12 - 2)]
    found = spark.createDataFrame(rows, "lang string, phrase string, size int, f long")
    out = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in collocations.scored(found).collect()}
    assert out == {
        "a b": (10**13, 2 * 10**13, 10**6 * (10**13 - 7) ** 2 // (2 * 10**26)),
        "a b c": (10**13, 10**12 - 1, 10**6 * (10**12 - 2) ** 2 // (10**13 * (10**12 - 1))),
    }


def test_a_task_gives_a_row_for_each_block_of_candidates(monkeypatch):
    """Counts of two tasks, packed, add up to those of all occurrences; words repeat no phrase for each task."""
    monkeypatch.setattr(collocations, "BLOCK", 16)
    words = [f"w{k}" for k in range(9)]
    pairs = sorted(f"{a} {b}" for a in words for b in words)
    tries = [collocations.build_trie(pa.array(["en"] * len(some)), pa.array(some)) for some in (pairs[:40], pairs[40:])]
    pick = random.Random(5)
    texts = [[" ".join(pick.choices(words, k=200)) for _ in range(20)] for _ in range(2)]
    batches = [pa.RecordBatch.from_arrays([pa.array(["en"] * 20), pa.array(x)], ["lang", "text"]) for x in texts]

    class Shared:
        value = tries

    packed = [b for x in batches for b in collocations._count(Shared)(iter([x]))]
    assert sum(b.num_rows for b in packed) == 2 * (3 + 3)
    found = Counter()
    for b in collocations._add_up(Shared)(iter(packed)):
        assert b.schema.names == ["lang", "phrase", "f"]
        found.update(dict(zip(b["phrase"].to_pylist(), b["f"].to_pylist(), strict=True)))
    each = [x.split() for some in texts for x in some]
    assert found == Counter(f"{a} {b}" for x in each for a, b in zip(x, x[1:], strict=False))
    assert [b.num_rows for b in collocations._count(Shared)(iter([]))] == [0, 0]


def test_a_task_names_phrases_in_one_row_for_each_part(monkeypatch):
    monkeypatch.setattr(collocations, "GROUPS", 4)

    class Shared:
        value = [np.full(1 << (collocations.BITS - 6), 2**64 - 1, np.uint64)] * 3

    texts = ["a b c d e f g. a b", "h i j a b c k"] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(["en", None] * 20), pa.array(texts)], ["lang", "text"])
    packed = pa.Table.from_batches(list(collocations._name(Shared)(iter([batch]))))
    assert packed.num_rows <= 4 * 2
    found = set()
    for k in range(len(packed)):
        group = pa.concat_tables([packed.slice(k, 1)] * 2)
        once = collocations._once(group).to_pylist()
        assert len({(r["phrase"], r["h"]) for r in once}) == len(once)
        found |= {(r["lang"], r["phrase"]) for r in once}
    want = set()
    for lang, pieces in (("en", ["a b c d e f g", "a b"]), ("und", ["h i j a b c k"])):
        for words in map(str.split, pieces):
            want |= {(lang, " ".join(words[i : i + n])) for n in (2, 3) for i in range(len(words) - n + 1)}
    assert found == want


def test_texts_are_scanned_as_often_for_many_candidates(spark, odd_texts, monkeypatch):
    """Candidates for many tries take no more scans of the texts than those for one."""
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(odd_texts)], "doc_id long, lang string, text string").repartition(3)
    scans, scan = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda *args, **more: scans.append(1) or scan(*args, **more))
    monkeypatch.setattr(collocations, "TRIES", 1)
    out = []
    for shard in (1 << 18, 20):
        monkeypatch.setattr(collocations, "SHARD", shard)
        out.append((got(collocations.report(df)), len(scans)))
        scans.clear()
    assert out[0] == out[1] and len(out[0][0]) > 50


def test_counts_of_tasks_and_windows_add_up_over_tries(monkeypatch):
    """A task gives its phrases several times over; a pair that stands in a triple is not counted with it again."""
    for name, value in (("GROUPS", 2), ("HELD", 40), ("SHARD", 7), ("TRIES", 2)):
        monkeypatch.setattr(collocations, name, value)

    class Shared:
        value = [np.full(1 << (collocations.BITS - 6), 2**64 - 1, np.uint64)] * 3

    pick, rows, want = random.Random(3), [], Counter()
    for _ in range(2):
        texts = [" ".join(pick.choices("abcdefg", k=30)) for _ in range(12)]
        # a slice for each text
        batches = [pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([x])], ["lang", "text"]) for x in texts]
        rows += collocations._name(Shared)(iter(batches))
        for words in map(str.split, texts):
            want.update(" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1))
    assert len(rows) > 4
    packed = pa.Table.from_batches(rows)
    found = [r for part in (0, 1) for r in collocations._tally(3)(packed.filter(pc.equal(packed["part"], part))).to_pylist()]
    assert {r["lang"] for r in found} == {"en"} and len({r["phrase"] for r in found}) == len(found) > 50
    assert {r["phrase"]: r["f"] for r in found} == {p: f for p, f in want.items() if f >= 3}


def test_a_bitmap_has_room_for_many_hashes(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITS", 10)
    monkeypatch.setattr(collocations, "MORE", 4)
    rng = np.random.default_rng(2)
    keys, others = rng.integers(0, 2**64, (2, 1000), np.uint64)
    bits = collocations._bitmap(spark.createDataFrame(pa.table({"h": keys.view(np.int64)}).to_pandas()))
    assert collocations._has(bits, keys).all() and collocations._has(bits, others).mean() < 0.2
    assert len(bits) == 1 << (14 - 6)
    few = collocations._bitmap(spark.createDataFrame([(int(x),) for x in keys[:3].view(np.int64)], "h long"))
    assert len(few) == 1 << (10 - 6) and collocations._has(few, keys[:3]).all()
