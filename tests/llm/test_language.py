from __future__ import annotations

import numpy as np
import pytest

from footfall.llm import language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def judged(given):
    return {r["doc_id"]: r for r in language.predict(given).collect()}


def test_held_out_accuracy(given, judged):
    mine = [(r["lang"], judged[r["doc_id"]]) for r in given.collect() if judged[r["doc_id"]]["held_out"]]
    assert sum(lang == j["lang_pred"] for lang, j in mine) / len(mine) > 0.95
    assert all(0 <= j["score"] <= 1 for _, j in mine)


def test_many_languages_pass_table_by_table(given, judged, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 1)
    out = language.predict(given).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in out} == {d: r["lang_pred"] for d, r in judged.items()}
    assert all(abs(r["score"] - judged[r["doc_id"]]["score"]) < 1e-9 for r in out)


def test_counts_are_those_of_all_training_text(given):
    """One table, against counting document by document."""
    import pyarrow as pa

    from footfall.llm.text import slices

    (names, logs), = language.tables(given)
    rows = [(r["lang"], r["text"]) for r in given.where(~language.held_out(given["doc_id"])).collect() if r["lang"] and r["text"]]
    for k, name in enumerate(names):
        total = np.full(language.BUCKETS, language.SMOOTHING)
        for part in slices(pa.array([t for lang, t in rows if lang == name])):
            for ids, _ in language._ngrams(part):
                total += np.bincount(ids, minlength=language.BUCKETS)
        assert np.allclose(logs[:, k], np.log(total / total.sum()), atol=1e-5)


def test_a_text_without_ngrams_gets_the_most_frequent_language(spark):
    rows = [(k, "der die das und" if k % 4 else "the of and to", "de" if k % 4 else "aa") for k in range(200)] + [(200, "x", None)]
    out = {r["doc_id"]: r for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert out[200]["lang_pred"] == "de" and 0.6 < out[200]["score"] < 0.9
    assert all(out[d]["lang_pred"] == lang for d, _, lang in rows[:200])


def test_odd_repeated_and_empty(odd, repeated, empty, odd_rows):
    out = {r["doc_id"]: r for r in language.predict(odd).collect()}
    assert len(out) == len(odd_rows)
    for doc, text, *_ in odd_rows:
        has_letter = any(c.isalpha() for c in text or "")
        assert (out[doc]["lang_pred"] == "und") != has_letter
    assert language.predict(repeated).count() == 2 * len(odd_rows) + 4
    assert language.predict(empty).collect() == []
    none = language.predict(odd.drop("lang").selectExpr("*", "cast(null as string) as lang")).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
