from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import suffix_dedup
from tests.llm.brute import repeated_bytes


def by_id(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def test_suffix_array_sorts_all_suffixes():
    pick = random.Random(1)
    for _ in range(500):
        text = [pick.randint(1, pick.choice((1, 2, 3, 10))) for _ in range(pick.randint(0, 60))] + [0]
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_given_documents(docs, rows):
    assert by_id(suffix_dedup.report(docs)) == repeated_bytes(rows)


@pytest.mark.parametrize("hot", [2, 10_000])
def test_small_blocks_and_hot_anchors(docs, rows, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 1 << 14)
    monkeypatch.setattr(suffix_dedup, "BATCH_CONTEXTS", 50)
    assert by_id(suffix_dedup.report(docs, hot)) == repeated_bytes(rows)


def test_odd_documents(odd, odd_rows):
    assert by_id(suffix_dedup.report(odd)) == repeated_bytes([r[:2] for r in odd_rows])


def test_passage_shared_at_every_offset(spark):
    pick = random.Random(5)
    noise = lambda n: "".join(pick.choice("abcdefgh ") for _ in range(n))
    passage = noise(230)
    made = [(i, noise(pick.randint(0, 60)) + passage[pick.randint(0, 60) : 230 - pick.randint(0, 60)] + noise(pick.randint(0, 90))) for i in range(80)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert by_id(suffix_dedup.report(df)) == repeated_bytes(made)


def test_repeated_rows_and_null_ids(repeated):
    """Of exact repeats one keeps its text; null ids come before the others."""
    out = suffix_dedup.report(repeated).collect()
    assert len(out) == repeated.count()
    of_null = sorted(r["n_removed"] for r in out if r["doc_id"] is None)
    assert 0 in of_null
    copies = [r for r in out if r["doc_id"] == 18]
    assert all(r["n_removed"] == r["n_bytes"] for r in copies)  # a null id has the same text


@pytest.mark.parametrize("hot", [2, 10_000])
def test_many_rows_without_or_with_one_id(spark, docs, rows, monkeypatch, hot):
    """A third of the rows lacks an id and a third shares one: they are spread over the blocks, and the result is
    that of the order (id, block, text)."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 1 << 14)
    made = [((None, 7, d)[d % 3], t) for d, t in rows]
    df = spark.createDataFrame(made, "doc_id long, text string")
    n = 1 + sum(len((t or "").encode()) for _, t in made) // (1 << 14)
    block = F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(n))
    blocks = [r[0] for r in df.select(block).collect()]
    assert n > 10 and max(blocks.count(b) for b in set(blocks)) < len(made) / 3
    order = sorted(range(len(made)), key=lambda i: (made[i][0] is not None, made[i][0] or 0, blocks[i], (made[i][1] or "").encode()))
    want = repeated_bytes([(k, made[i][1]) for k, i in enumerate(order)])
    out = sorted(tuple(r)[1:] for r in suffix_dedup.report(df, hot).collect())
    assert out == sorted(want[k] for k in range(len(made)))


def bundle(texts):
    """A block of these texts."""
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "block", "text"])
    return pa.Table.from_batches(list(suffix_dedup._bundle(iter([batch]))))


@pytest.mark.parametrize("piece", [1, 70, 1000])
def test_pieces_of_a_block_give_its_reports(odd_rows, rows, monkeypatch, piece):
    table = bundle([(t or "")[:3000] for _, t, *_ in odd_rows] + [t or "" for _, t in rows[:10]])
    whole = suffix_dedup._reports(table)
    assert len(whole) > 100
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", piece)
    assert suffix_dedup._reports(table).equals(whole)


@pytest.mark.parametrize("texts", [1, 500])
def test_memory_of_a_block(texts):
    """A task's arrays stay a small multiple of its block, be it many texts or one long one."""
    data, n = np.random.default_rng(6).integers(97, 123, suffix_dedup.BLOCK_BYTES, np.uint8).tobytes().decode(), suffix_dedup.BLOCK_BYTES // texts
    table = bundle([data[k * n : (k + 1) * n] for k in range(texts)])
    found = suffix_dedup._reports(table)
    starts = np.arange(0, n * texts - 100, 70)
    ranges = pa.table({"block": np.zeros(len(starts), np.int64), "start": starts, "stop": starts + 20})
    for step in (lambda: suffix_dedup._reports(table), lambda: suffix_dedup._fetch(table, found), lambda: suffix_dedup._digest(table, ranges)):
        tracemalloc.start()
        step()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 20 * suffix_dedup.BLOCK_BYTES


def test_texts(docs, rows):
    kept = {r["doc_id"]: bytes(r["text"]) for r in suffix_dedup.dedup(docs).collect()}
    want = repeated_bytes(rows)
    assert all(len(kept[d]) == n - gone for d, (n, gone, *_) in want.items())


def test_empty(empty):
    assert suffix_dedup.report(empty).collect() == []
