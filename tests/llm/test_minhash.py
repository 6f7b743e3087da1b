from __future__ import annotations

import random

import numpy as np
import pytest

from footfall.llm import minhash
from tests.llm.brute import near_groups
from tests.llm.conftest import prose


def by_id(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_given_documents(docs, rows):
    want = near_groups(rows)
    assert by_id(minhash.report(docs)) == want and len({w[1] for w in want.values()}) < len(want)


def test_odd_documents(odd, odd_rows):
    assert by_id(minhash.report(odd)) == near_groups([r[:2] for r in odd_rows])


@pytest.mark.parametrize("block", [3, 256])
def test_chains_of_near_copies(spark, monkeypatch, block):
    """Each text is a little further from the first one: links run along the chain only."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    pick, made = random.Random(3), []
    for group in range(6):
        words = prose(group, 120).split()
        for step in range(14):
            made.append((group * 100 + (step * 5) % 14, " ".join(words)))
            for _ in range(pick.randint(1, 4)):
                words[pick.randrange(len(words))] = f"w{pick.randrange(10**6)}"
    pick.shuffle(made)
    want = near_groups(made)
    assert by_id(minhash.report(spark.createDataFrame(made, "doc_id long, text string"))) == want


def test_one_large_group(spark):
    """Hundreds of near copies that all share most bands."""
    base, pick = prose(9, 200).split(), random.Random(4)
    made = []
    for k in range(300):
        words = list(base)
        for _ in range(pick.randint(0, 25)):
            words[pick.randrange(200)] = f"w{pick.randrange(10**6)}"
        made.append((k, " ".join(words)))
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert by_id(minhash.report(df)) == near_groups(made)


def test_circulant_coordinates():
    """Each coordinate is the first permutation's places, moved on by one, under the second permutation."""
    h = np.arange(1, 50, dtype=np.uint64)
    one = minhash.signatures(h, np.array([0, 20, 49]))
    place = (minhash.mix(h) >> np.uint64(32)).astype(np.uint32)
    for k in (0, 1, 127):
        moved = minhash._permuted(place + np.uint32(k))
        assert one[0, k] == moved[:20].min() and one[1, k] == moved[20:].min()
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(minhash._permuted(x))) == len(x)


def test_keep_one(odd, repeated, odd_rows, docs, rows):
    kept = {r["doc_id"] for r in minhash.keep_one(docs).collect()}
    assert kept == {d for d, (*_, k) in near_groups(rows).items() if k}
    out = minhash.keep_one(odd)
    assert out.schema == odd.schema
    some = minhash.keep_one(repeated).collect()
    with_words = [r for r in some if (r["text"] or "").strip(" \t\n")]
    assert len(with_words) == len({(r["doc_id"], r["text"]) for r in with_words})
    assert sum(r["text"] is None for r in some) == 2  # without words: kept as they come


def test_keep_one_of_copies_without_an_id_of_their_own(spark):
    near = lambda name, n: [f"{' '.join(f'{name}{k}' for k in range(60))} end{j}" for j in range(n)]
    rows = [(None, t) for t in near("a", 3)] + [(5, t) for t in near("b", 3)] + [(None, t) for t in near("c", 2)] + [(9, near("c", 3)[2])] + [(5, "five other words stand here alone")]
    out = [tuple(r) for r in minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted((d is None, d or 0, t[0]) for d, t in out) == [(False, 5, "b"), (False, 5, "f"), (False, 9, "c"), (True, 0, "a")]


def test_null_ids(repeated):
    out = minhash.report(repeated).collect()
    nulls = [r for r in out if r["doc_id"] is None and r["n_shingles"] > 1]
    assert nulls and all(r["component_id"] == 18 and not r["kept"] for r in nulls)


def test_empty(empty):
    assert minhash.report(empty).collect() == [] and minhash.keep_one(empty).collect() == []
