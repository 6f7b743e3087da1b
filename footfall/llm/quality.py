"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its hashed words, word repetitions and character 3- and
4-grams; a linear layer and softmax give class probabilities. Training is minibatch gradient descent in
numpy with per-weight step sizes, on at most SAMPLE labelled documents (a documented bound; the smallest
hashes of the labelled ids, so the choice depends on ids alone). Features of the sample are computed by
Spark, at most BUCKETS numbers a document, and one task learns from them.

The mean is linear, so scoring needs one learned number per bucket: vectors times layer. That table
(BUCKETS floats) is all that travels to the tasks, and documents are scored where they are read.

Defined results: null and empty texts get the score of a zero vector (the learned bias); without any
usable label every score is 0.5; repeated rows score alike; null ids are never learned from; labels other
than 0 and 1 are ignored; other columns pass through `keep_good` untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.text import NOT_SPACE, BYTE_CODES, Slice, find_words, mix, slices

BUCKETS = 1 << 15
SAMPLE = 6000
DIM = 16
EPOCHS = 12
BATCH = 64
RATE = 0.2
THRESHOLD = 0.3

_SHIFT = np.uint64(49)  # keeps 15 bits


def held_out(doc_id: Column) -> Column:
    """True for a fifth of the ids, by their checksum, and for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def features(part: Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket numbers and the row of each, kind by kind."""
    lengths = np.diff(part.offsets)
    words = find_words(part, NOT_SPACE, BYTE_CODES)
    rows = np.repeat(np.arange(len(part), dtype=np.int32), np.diff(words.bounds))
    h = words.hashes
    yield (h >> _SHIFT).astype(np.int32), rows
    for gap in (1, 2, 3):  # a word that comes back is a feature of its own, whatever the word
        if len(h) > gap:
            inside = rows[gap:] == rows[:-gap]
            yield np.where(h[gap:] == h[:-gap], gap, 8 + gap).astype(np.int32)[inside], rows[gap:][inside]
    rows = np.repeat(np.arange(len(part), dtype=np.int32), lengths)
    codes = BYTE_CODES[part.data]
    for n in (3, 4):
        m = len(codes) - n + 1
        if m > 0:
            g = codes[:m].copy()
            for k in range(1, n):
                g *= np.uint64(0x9E3779B97F4A7C15)
                g += codes[k : k + m]
            inside = rows[:m] == rows[n - 1 :]
            yield (mix(g + np.uint64(n)) >> _SHIFT).astype(np.int32)[inside], rows[:m][inside]


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label and mean feature vector as bucket numbers and shares."""
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for part in slices(batch.column(0)):
            ids, shares = [], []
            both = [x[1].astype(np.int64) * BUCKETS + x[0] for x in features(part)]
            keys, counts = np.unique(np.concatenate(both), return_counts=True)
            bounds = np.searchsorted(keys, np.arange(len(part) + 1) * BUCKETS)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                ids.append((keys[a:b] % BUCKETS).astype(np.uint16).tobytes())
                shares.append((counts[a:b] / max(1, counts[a:b].sum())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels[part.first : part.last], pa.int32()), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())],
                ["label", "ids", "shares"],
            )


@dataclass
class Model:
    """What scoring needs: a number per bucket and a bias."""

    weights: np.ndarray
    bias: float


def fit(rows: list[tuple[int, bytes, bytes]]) -> Model:
    """Minibatch descent over vectors, layer and bias; the same rows give the same model."""
    rows = [r for r in rows if len(r[1])]
    if not rows:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(6)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen = [np.full(x.shape, 1e-8, np.float32) for x in (vectors, layer, bias)]
    x = np.zeros((BATCH, BUCKETS), np.float32)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(rows), BATCH):
            some = [rows[i] for i in order[at : at + BATCH]]
            x[:] = 0
            for i, (_, ids, shares) in enumerate(some):
                x[i, np.frombuffer(ids, np.uint16)] = np.frombuffer(shares, np.float32)
            y = np.array([r[0] for r in some])
            hidden = x[: len(some)] @ vectors
            out = hidden @ layer + bias
            p = np.exp(out - out.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), y] -= 1
            p /= len(some)
            steps = (x[: len(some)].T @ (p @ layer.T), hidden.T @ p, p.sum(0))
            for value, step, total in zip((vectors, layer, bias), steps, seen, strict=True):
                total += step * step
                value -= rate * step / np.sqrt(total)
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def _fit_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows of a partition."""
    rows = [row for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)]
    model = fit(sorted(rows))
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.bias])], ["weights", "bias"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the labelled documents whose ids are not held out, at most `sample` of them: the bound cuts the
    labels of rows that `docs` has. One task learns from the features of the sample; only the model comes to the
    driver."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    usable = usable.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = usable.select("doc_id", F.col("quality").cast("int").alias("__label")).orderBy(F.xxhash64("doc_id"), "doc_id", "__label")
    chosen = chosen.limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "__label")
    rows = texts.mapInArrow(_sparse, "label int, ids binary, shares binary")
    (row,) = rows.repartition(1).mapInArrow(_fit_sample, "weights binary, bias double").collect() or [None]
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"]) if row else fit([])


def _score(model, column: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value.weights, model.value.bias
        for batch in batches:
            out = [np.empty(0)]
            for part in slices(batch.column(batch.schema.get_field_index(column))):
                total, n = np.zeros(len(part)), np.zeros(len(part), np.int64)
                for ids, rows in features(part):
                    total += np.bincount(rows, weights[ids], len(part))
                    n += np.bincount(rows, minlength=len(part))
                out.append(1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + bias, -40, 40))))
            score = pa.array(np.concatenate(out), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "__score"])

    return run


def add_score(docs: DataFrame, model: Model) -> DataFrame:
    """docs and `__score`, the probability of label 1 by its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType())])
    return docs.mapInArrow(_score(shared, "text"), kinds)


def predict(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    scored = add_score(docs.select("doc_id", "text"), train(docs, labels, sample))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier accepts, columns as given."""
    return add_score(docs, train(docs, labels, sample)).where(F.col("__score") >= THRESHOLD).drop("__score")
