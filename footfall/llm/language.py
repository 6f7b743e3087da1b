"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting covers every training text: tasks add up n-gram counts per language and bucket before the
shuffle, so a partition sends at most languages times BUCKETS numbers. Languages are dealt to groups of
LANGUAGES, so that a table of log-probabilities never exceeds LANGUAGES * BUCKETS floats (16 MB); with
more languages, documents pass one table after the other without a shuffle, keeping the best so far.

ASCII letters are folded to lower case, other ASCII characters count as blanks, so digits and marks tell
nothing. The prior of a language is its share of the training documents. The score is the posterior
probability, tempered by the square root of the number of n-grams.

Defined results: `und` with score 0 for null texts, texts without a letter, or when nothing can be
learned; ties go to the language that sorts first; repeated rows are judged alike; null ids are never
learned from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.quality import held_out
from footfall.llm.text import BYTE_CODES, Slice, mix, slices

BUCKETS = 1 << 15
LANGUAGES = 128
SMOOTHING = 0.1
_SHIFT = np.uint64(49)


_ASCII = np.full(256, 32, np.uint8)
_ASCII[97:123] = np.arange(97, 123)
_ASCII[65:91] = np.arange(97, 123)
_ASCII[128:] = np.arange(128, 256)


def _ngrams(part: Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and rows of byte 2-, 3- and 4-grams of folded text, without those that hold only blanks."""
    folded = _ASCII[part.data]
    rows = np.repeat(np.arange(len(part), dtype=np.int32), np.diff(part.offsets))
    codes, blank = BYTE_CODES[folded], folded == 32
    for n in (2, 3, 4):
        m = len(codes) - n + 1
        if m <= 0:
            continue
        g = codes[:m].copy()
        good = (rows[:m] == rows[n - 1 :]) & ~(blank[:m] & blank[1 : m + 1])
        for k in range(1, n):
            g *= np.uint64(0x9E3779B97F4A7C15)
            g += codes[k : k + m]
        yield (mix(g + np.uint64(n)) >> _SHIFT).astype(np.int32)[good], rows[:m][good]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, bucket) of a partition."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for part in slices(batch.column(0)):
            names, code = np.unique(langs[part.first : part.last].astype(str), return_inverse=True)
            table = np.zeros(len(names) * BUCKETS, np.int64)
            for ids, rows in _ngrams(part):
                table += np.bincount(code[rows] * BUCKETS + ids, minlength=len(table))
            for k, name in enumerate(names.tolist()):
                totals[name] = totals.get(name, 0) + table[k * BUCKETS : (k + 1) * BUCKETS]
    for name, table in totals.items():
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(table[at], pa.int64())], ["lang", "bucket", "n"]
        )


def _training(docs: DataFrame) -> DataFrame:
    return docs.where("lang is not null and text is not null").where(~held_out(F.col("doc_id"))).select("text", "lang")


def tables(docs: DataFrame) -> Iterator[tuple[list[str], np.ndarray]]:
    """Languages in order, and log-probabilities (bucket by language), group by group."""
    counts = _training(docs).mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    pack = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))  # at most BUCKETS a language
    group: list[tuple[str, np.ndarray]] = []
    for row in pack.orderBy("lang").toLocalIterator():
        table = np.full(BUCKETS, SMOOTHING)
        for bucket, n in row["cells"]:
            table[bucket] += n
        group.append((row["lang"], np.log(table / table.sum()).astype(np.float32)))
        if len(group) == LANGUAGES:
            yield [x[0] for x in group], np.stack([x[1] for x in group], 1)
            group = []
    if group:
        yield [x[0] for x in group], np.stack([x[1] for x in group], 1)


def priors(docs: DataFrame) -> dict[str, float]:
    """The logarithm of each language's number of training documents; its share up to a constant."""
    counts = _training(docs).groupBy("lang").agg(F.count("*").alias("n"))
    return {row["lang"]: float(np.log(row["n"])) for row in counts.toLocalIterator()}


def _judge(shared, first: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Carries the best language, its log-likelihood and the sum of all likelihoods from table to table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs, prior = shared.value
        for batch in batches:
            n = len(batch)
            best, most, total = np.full(n, None, object), np.full(n, -np.inf), np.full(n, -np.inf)
            if not first:
                best = np.array(batch.column(2).to_pylist(), object)
                most, total = (batch.column(k).to_numpy(zero_copy_only=False).copy() for k in (3, 4))
            for part in slices(batch.column(1)):
                size, sums = np.zeros(len(part)), np.tile(prior, (len(part), 1))
                for ids, rows in _ngrams(part):
                    size += np.bincount(rows, minlength=len(part))
                    for k in range(len(names)):
                        sums[:, k] += np.bincount(rows, logs[ids, k], len(part))
                sums /= np.sqrt(np.maximum(size, 1))[:, None]
                at = slice(part.first, part.last)
                top = sums.argmax(1)
                here = sums[np.arange(len(part)), top]
                whole = here + np.log(np.exp(sums - here[:, None]).sum(1))
                better = here > most[at]
                best[at] = np.where(better, np.array(names, object)[top], best[at])
                total[at] = np.logaddexp(total[at], whole)
                most[at] = np.where(better, here, most[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best.tolist(), pa.string()), pa.array(most), pa.array(total)],
                [*batch.schema.names[:2], "lang_pred", "best", "total"],
            )

    return run


def predict(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    out, first = docs.select("doc_id", "text"), True
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema)
    prior = priors(docs)
    for names, logs in tables(docs):
        table = (names, logs, np.array([prior[name] for name in names]))
        out = out.mapInArrow(_judge(spark.sparkContext.broadcast(table), first), f"{fields}, lang_pred string, best double, total double")
        first = False
    known = F.lit(False) if first else F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if first:
        out = out.withColumns({"lang_pred": F.lit(None).cast("string"), "best": F.lit(0.0), "total": F.lit(0.0)})
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.when(known, F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(known, F.least(F.lit(1.0), F.exp(F.col("best") - F.col("total")))).otherwise(0.0).alias("score"),
    )
