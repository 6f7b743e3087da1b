from __future__ import annotations

import random

import pytest

from footfall.llm import decontaminate
from tests.llm.brute import contamination
from tests.llm.conftest import SF


def by_id(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def items_of(df):
    return [tuple(r) for r in df.select("item_id", "text").collect()]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 500])
def test_given_documents(docs, rows, benchmark, shard_bytes):
    out = by_id(decontaminate.report(docs, benchmark, shard_bytes=shard_bytes))
    want = contamination(rows, items_of(benchmark))
    assert out == want and any(x[-1] for x in want.values())


def test_many_shards_in_one_pass(spark, docs, rows, benchmark, monkeypatch):
    """Fifty shards are one Python operator, and a task holds one automaton at a time."""
    items = items_of(benchmark)
    size = sum(len((t or "").encode()) for _, t in items) // 50
    found = decontaminate.find_contamination(docs.select("doc_id", "text"), benchmark, shard_bytes=size)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    monkeypatch.setattr(decontaminate, "HELD_BYTES", 1 << 14)
    monkeypatch.setattr(decontaminate.Sieve, "CHUNK", 64)
    assert by_id(decontaminate.report(docs, benchmark, shard_bytes=size)) == contamination(rows, items)
    automata = [Kept(a) for a, _, _ in decontaminate.shards(benchmark, decontaminate.WINDOW, size)]
    assert len(automata) > 25
    sieves = Kept([decontaminate.Sieve(*x) for x in grouped(decontaminate.shards(benchmark, decontaminate.WINDOW, size))])
    batches = docs.select("doc_id", "text").toArrow().to_batches()
    out = list(decontaminate._walk(automata, sieves, "text")(iter(batches)))
    assert sum(len(b) for b in out) == len(rows) and sum(a.reads > 0 for a in automata) > 1
    assert sum("_value" in vars(a) for a in automata) == 1


class Kept:
    """A broadcast as a worker sees it: read when asked for, then kept."""

    def __init__(self, value):
        self.stored, self.reads = value, 0

    @property
    def value(self):
        if "_value" not in vars(self):
            self._value, self.reads = self.stored, self.reads + 1
        return self._value


def grouped(shards):
    known, shortest = {}, {}
    for k, (automaton, q, own) in enumerate(shards):
        known.setdefault(q, {})[k] = own
        shortest[k] = automaton.shortest
    return [(q, own, shortest) for q, own in known.items()]


@pytest.mark.parametrize("seed", range(4))
def test_random_words(spark, seed):
    """Few different words, so windows overlap, nest and repeat; short items among them."""
    pick = random.Random(seed)
    text = lambda n: " ".join(pick.choice("abcd") for _ in range(n))
    items = [(k, text(pick.choice((1, 3, 9, 10, 11, 30)) if seed else pick.randint(10, 30))) for k in range(12)]
    items += [(None, text(12)), (3, text(11)), (50, ""), (51, None), (52, "!?")]
    some = [(k, text(pick.randint(0, 200))) for k in range(60)]
    some += [(100 + k, items[k][1] + " x " + items[k + 1][1]) for k in range(6)]
    df = spark.createDataFrame(some, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert by_id(decontaminate.report(df, bench)) == contamination(some, items)
    assert by_id(decontaminate.report(df, bench, shard_bytes=60)) == contamination(some, items)


def test_odd_documents(odd, odd_rows, benchmark, repeated, empty):
    assert by_id(decontaminate.report(odd, benchmark)) == contamination([r[:2] for r in odd_rows], items_of(benchmark))
    assert decontaminate.report(repeated, benchmark).count() == 2 * len(odd_rows) + 4
    assert decontaminate.report(empty, benchmark).collect() == []
    none = benchmark.where("false")
    assert not any(r["contaminated"] for r in decontaminate.report(odd, none).collect())


def test_cutting(spark, benchmark, docs, rows):
    item = items_of(benchmark)[0][1].replace("\n", " ")
    clean = "nothing to see here " * 20
    some = [(0, f"{clean}{item} {clean}", "kept"), (1, item, "kept"), (2, clean, "kept"), (3, None, "kept")]
    df = spark.createDataFrame(some, "doc_id long, text string, __hits string")
    out = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(df, benchmark).collect()}
    assert set(out) == {0, 2, 3} and out[2] == clean and out[3] is None
    assert out[0].startswith(clean) and out[0].endswith(clean) and len(out[0]) < len(clean) * 2 + 5
    whole = decontaminate.decontaminate(docs, benchmark)
    assert whole.schema == docs.schema
    want = contamination(rows, items_of(benchmark))
    kept = {r["doc_id"]: r["text"] for r in whole.collect()}
    assert all(kept[d] == t for d, t in rows if not want[d][-1])
    assert not any(r["contaminated"] for r in decontaminate.report(whole, benchmark).collect())
