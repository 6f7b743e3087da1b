from __future__ import annotations

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import packing


def padding(lengths, ends):
    return sum(min(e for e in ends if e >= n) - n for n in lengths)


@pytest.mark.parametrize("seed", range(5))
def test_boundaries_have_the_least_padding(seed):
    pick = random.Random(seed)
    lengths = [pick.choice((pick.randint(1, 9), pick.randint(1, 40))) for _ in range(60)]
    for buckets in (1, 2, 3, 4):
        sizes = sorted(set(lengths))
        ends, cost = packing.boundaries(np.array(sizes), np.array([lengths.count(n) for n in sizes]), buckets)
        best = min(padding(lengths, [*c, sizes[-1]]) for c in itertools.combinations(sizes[:-1], buckets - 1))
        assert cost == best == padding(lengths, ends) and len(ends) <= buckets


def test_boundaries_of_huge_and_of_many_lengths():
    """Paddings beyond 64 bits stay exact, and doubling every count changes nothing but the padding."""
    pick = random.Random(3)
    sizes = sorted(pick.sample(range(1, 1 << 20), 300))
    counts = [pick.randint(1, 50) for _ in sizes]
    ends, cost = packing.boundaries(np.array(sizes), np.array(counts), 8)
    assert sum((min(e for e in ends if e >= s) - s) * c for s, c in zip(sizes, counts, strict=True)) == cost
    big = packing.boundaries(np.array(sizes), np.array(counts) * (1 << 50), 8)
    assert big == (ends, cost * (1 << 50))
    # against the plain program, all pairs
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(8):
        new = list(best)
        for j in range(1, len(sizes) + 1):
            pad = 0
            for i in range(j - 1, -1, -1):
                pad += (sizes[j - 1] - sizes[i]) * counts[i]
                new[j] = min(new[j], best[i] + pad)
        best = new
    assert best[-1] == cost
    many = np.unique(np.random.default_rng(1).integers(1, 1 << 20, 200_000))
    assert len(packing.boundaries(many, np.ones(len(many), np.int64), 16)[0]) == 16


def test_rows_without_id_are_spread(spark, monkeypatch):
    """A third of the rows lacks an id and has one length: no shard holds them all, batches are dense."""
    monkeypatch.setattr(packing, "SHARD_ROWS", 100)
    rows = [(None if k % 3 == 0 else k, f"{k:09d}") for k in range(3000)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), budget=900)
    check(out.collect(), rows, 900)
    sizes = [r["count"] for r in spark.createDataFrame(rows, "doc_id long, text string").groupBy(F.pmod(F.xxhash64("doc_id", F.lit(9).cast("long"), "text"), F.lit(31))).count().collect()]
    assert max(sizes) < 200


def test_long_lengths_have_the_least_padding(spark):
    """Lengths that differ by less than a 64th are kept apart."""
    out = packing.report(spark.createDataFrame(enumerate(["x" * n for n in [1024] * 10 + [1030] + [2000] * 10]), "doc_id long, text string"), buckets=3).collect()
    assert {r["bucket_len"] for r in out} == {1024, 1030, 2000} and all(r["bucket_len"] == r["n_tokens"] for r in out)
    pick = random.Random(7)
    lengths = [pick.randint(1000, 1060) if pick.random() < 0.7 else pick.randint(1, 5000) for _ in range(60)]
    out = packing.report(spark.createDataFrame(enumerate("x" * n for n in lengths), "doc_id long, text string"), buckets=3).collect()
    sizes = sorted(set(lengths))
    assert sum(r["bucket_len"] - r["n_tokens"] for r in out) == min(padding(lengths, [*c, sizes[-1]]) for c in itertools.combinations(sizes[:-1], 2))


def check(out, rows, budget=packing.BUDGET):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in out) == sorted((d is None, d or 0, len((t or "").encode())) for d, t in rows)
    ends = sorted({r["bucket_len"] for r in out})
    batches = defaultdict(list)
    for r in out:
        assert r["n_tokens"] <= r["bucket_len"] and not any(r["n_tokens"] <= e < r["bucket_len"] for e in ends)
        batches[r["bucket_len"], r["batch"]].append(r["slot"])
    for end, group in itertools.groupby(sorted(batches), key=lambda k: k[0]):
        room, numbers = max(1, budget // max(end, 1)), [k[1] for k in group]
        assert numbers == list(range(len(numbers)))
        for n in numbers:
            full = room if n < len(numbers) - 1 else len(batches[end, n])
            assert sorted(batches[end, n]) == list(range(full)) and full <= room


@pytest.mark.parametrize("shard_rows", [7, 20_000])
def test_given_documents(docs, rows, monkeypatch, shard_rows):
    monkeypatch.setattr(packing, "SHARD_ROWS", shard_rows)
    check(packing.report(docs).collect(), rows)


def test_odd_repeated_and_empty(odd, odd_rows, repeated, empty):
    check(packing.report(odd).collect(), [r[:2] for r in odd_rows])
    check(packing.report(repeated).collect(), [r[:2] for r in odd_rows] * 2 + [(None, r[1]) for r in odd_rows[5:9]])
    assert packing.report(empty).collect() == []
    packed = packing.pack(odd)
    assert packed.columns.count("batch") == 1 and "score" in packed.columns


def test_own_lengths(docs, rows):
    assert packing.report(docs.withColumn("n_chars", F.lit(None))).count() == len(rows)
    assert packing.pack(docs, length=F.lit(None)).where("n_tokens = 0 and batch is not null").count() == len(rows)
    out = packing.pack(docs, buckets=3, budget=5000, length=F.col("n_chars")).collect()
    assert len(out) == len(rows) and len({r["bucket_len"] for r in out}) <= 3
