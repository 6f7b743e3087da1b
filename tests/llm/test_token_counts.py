from __future__ import annotations

import math

import pytest

from footfall.llm import token_counts
from tests.llm.conftest import prose

PIECES = token_counts.load_pieces()


def count(word: str) -> int:
    """Number of pieces of the best segmentation, by position."""
    longest, byte = max(map(len, PIECES)), min(PIECES.values()) - 1.0
    best = [(0.0, 0)]
    for n in range(1, len(word) + 1):
        size = len(word[n - 1].encode())
        options = [(best[n - 1][0] + size * byte, -(best[n - 1][1] + size))]
        options += [(best[k][0] + PIECES[word[k:n]], -(best[k][1] + 1)) for k in range(max(0, n - longest), n) if word[k:n] in PIECES]
        score, pieces = max(options)
        best.append((score, -pieces))
    return best[-1][1]


def want(text):
    words = (text or "").encode().split()
    return len(words), sum(count(token_counts.MARK + w.decode()) for w in words)


def test_given_documents(docs, rows):
    some = [r for r in rows if r[0] % 4 == 0]
    out = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in token_counts.report(docs).collect()}
    assert len(out) == len(rows)
    for doc, text in some:
        assert out[doc] == want(text)


def test_odd_documents(odd, odd_rows):
    out = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in token_counts.report(odd).collect()}
    for doc, text, *_ in odd_rows:
        if len(text or "") < 10_000:
            assert out[doc] == want(text)


@pytest.mark.parametrize("limit", ["MAX_NODES", "MAX_KEPT", "MAX_WORDS"])
def test_bounds_change_no_count(monkeypatch, limit):
    text = prose(3, 400) + " " + "unbelievably" * 30
    monkeypatch.setattr(token_counts, limit, 6)
    trie = token_counts.Trie(token_counts.Pieces(PIECES))
    assert sum(trie.counts[w] for w in text.encode().split()) == want(text)[1]


def test_prefixes_are_shared():
    trie = token_counts.Trie(token_counts.Pieces({"a": math.log(0.5), "ab": math.log(0.4), "b": math.log(0.1)}))
    for word in ("abab", "aba", "abb", "aba"):
        trie.insert(word)
    assert len(trie.score) == 1 + 4 + 1  # the root, abab, and abb's last letter


def test_repeated_and_empty(repeated, empty, odd_rows):
    assert token_counts.report(repeated).count() == 2 * len(odd_rows) + 4
    assert token_counts.report(empty).collect() == []
