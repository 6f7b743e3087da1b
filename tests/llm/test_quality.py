from __future__ import annotations

import zlib

import pytest

from footfall.llm import quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def scored(spark, labels):
    return quality.predict(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect()


def test_held_out_accuracy(scored, labels):
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    mine = [r for r in scored if r["held_out"] and r["doc_id"] in truth]
    right = [r["predicted"] == truth[r["doc_id"]] for r in mine]
    assert len(right) > 50 and sum(right) / len(right) > 0.95
    bad = [r for r in mine if truth[r["doc_id"]] == 0]
    assert sum(r["predicted"] == 0 for r in bad) > 0.8 * len(bad)


def test_columns(scored):
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_labels_of_held_out_ids_change_nothing(spark, labels, scored):
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.predict(spark.read.parquet(f"{SF}/documents.parquet"), turned).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, scored))


def test_odd_repeated_and_empty(odd, repeated, empty, labels, odd_rows):
    out = quality.predict(odd, labels).collect()
    assert len(out) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (0, 3)}) == 1  # null and empty text
    assert quality.predict(repeated, labels).count() == 2 * len(odd_rows) + 4
    assert quality.predict(empty, labels).collect() == []
    assert {r["score"] for r in quality.predict(odd, labels.where("false")).collect()} == {0.5}


def test_keep_good(spark, labels, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored if r["predicted"]}


def test_the_bound_cuts_labels_of_present_documents(spark, labels, monkeypatch):
    """A hundred labels for each document that is there: the sample is still full."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    strange = spark.range(10**6, 10**6 + 100 * docs.count()).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    plain = quality.train(docs, labels.select("doc_id", "quality"), 200)
    assert quality.train(docs, labels.select("doc_id", "quality").unionByName(strange), 200).weights.tobytes() == plain.weights.tobytes()


def test_scores_by_hand(spark, labels):
    """Every score again from the learned table, document by document."""
    import math

    import pyarrow as pa

    from footfall.llm.text import slices

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, labels)
    got = {r["doc_id"]: r["__score"] for r in quality.add_score(docs, model).collect()}
    for r in docs.collect():
        total, n = 0.0, 0
        for part in slices(pa.array([r["text"]], pa.string())):
            for ids, _ in quality.features(part):
                total += sum(float(model.weights[i]) for i in ids.tolist())
                n += len(ids)
        want = 1 / (1 + math.exp(-(total / max(n, 1) + model.bias)))
        assert abs(got[r["doc_id"]] - want) < 1e-6
