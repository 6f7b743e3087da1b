from __future__ import annotations

import pytest

import corpus_pipeline
from footfall.llm import quality
from tests.llm.brute import contamination, near_groups, strong_secrets
from tests.llm.conftest import KINDS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def result(spark):
    return {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}


def test_against_brute_force(spark, result):
    """Stage after stage over the whole table; the classifier's scores are its own, checked elsewhere."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r["doc_id"] for r in quality.predict(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r["predicted"]}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in good}
    kept = {d for d, (*_, k) in near_groups(list(texts.items())).items() if k}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hits = contamination([(d, texts[d]) for d in kept], items)
    left = {d for d in kept if hits[d][1] <= 0.5 * hits[d][0]}
    assert set(result) == left and 0 < len(left) <= len(kept) < len(texts) < docs.count()
    for d in left:
        if not hits[d][-1] and not strong_secrets(texts[d]):
            assert result[d]["text"] == texts[d]
    after = contamination([(d, r["text"]) for d, r in result.items()], items)
    assert not any(x[-1] for x in after.values())
    assert not any(strong_secrets(r["text"]) for r in result.values())


def test_batches_fit(result):
    from collections import Counter

    sizes = Counter((r["bucket_len"], r["batch"]) for r in result.values())
    assert all(end * n <= 65536 or n == 1 for (end, _), n in sizes.items())


def test_stages_keep_the_columns(spark, tmp_path):
    """Odd rows go through every stage, written and read between them."""
    import shutil

    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words here", None, None, 15), (3, "x " * 3000, "en", "s", 6000)]
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    for some in (rows, []):
        docs = spark.createDataFrame(some, KINDS)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.dtypes == docs.dtypes
            path = str(tmp_path / f"{k}-{len(some)}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
