"""Packing into optimal length buckets.

Lengths (bytes, the tokens of a byte-level model, unless another column is given) are counted in one global
histogram of exact lengths, and a dynamic program over it picks the bucket boundaries with the least total
padding, in numpy inside one task, in time proportional to buckets times lengths times their logarithm; only
the boundaries come to the driver. m different lengths add up to m * m / 2 at least, so
30 GB of text have fewer than 250,000, 1 TB fewer than 1.5 million and 100 TB fewer than 15 million. A bucket
pads to its boundary; a batch takes `budget // boundary` documents, at least one.

Documents of a bucket are numbered without a global sort: (bucket, shard) groups of about SHARD_ROWS rows
are counted, a running sum over those counts gives each its offset, and rows are numbered inside their
group. Rows are dealt to shards by id, length and text, so rows without id, or with one id, are spread; only
rows equal in all three are numbered in one group, as a stream of sorted rows.

Defined results: null and empty texts, and null lengths, have length 0 and are packed in the smallest bucket; a text longer
than the budget fills a batch alone; repeated rows are packed each; an empty table gives an empty result;
columns of the input pass through `pack`, but for those named like its own outputs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKETS = 16
BUDGET = 65536
SHARD_ROWS = 20_000


def byte_tokens(text: Column) -> Column:
    """Length for a byte-level model."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _cheapest(best: np.ndarray, top: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One bucket more: for each j the least best[i] + padding of the lengths i..j-1, i < j, and the first such i.

    The best i never falls as j rises, so the j in the middle of two known ones searches between their answers:
    level by level, each in a few numpy passes over about as many candidates as there are lengths."""
    m = len(top)
    at, new = np.zeros(m + 2, np.int64), best.copy()
    at[m + 1] = m - 1
    step = 1 << max(0, m.bit_length() - 1)
    while step:
        js = np.arange(step, m + 1, 2 * step)
        low = at[js - step]
        high = np.minimum(at[np.minimum(js + step, m + 1)], js - 1)
        size = high - low + 1
        first = np.r_[0, np.cumsum(size)[:-1]]
        i = np.arange(size.sum()) - np.repeat(first - low, size)
        j = np.repeat(js, size)
        cost = best[i] + (top[j - 1] * (n[j] - n[i]) - (total[j] - total[i]))
        least = np.minimum.reduceat(cost, first)
        hit = np.flatnonzero(cost == np.repeat(least, size))
        at[js] = i[hit[np.searchsorted(hit, first)]]
        new[js] = least
        step //= 2
    return new, at[: m + 1]


def boundaries(sizes: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[list[int], int]:
    """Upper ends with the least padding, and that padding. sizes: distinct lengths, ascending; counts: documents."""
    m = len(sizes)
    if not m:
        return [], 0
    # Paddings are exact: whole numbers of any size where 64 bits might not hold them.
    kind = np.int64 if int(sizes[-1]) * (sum(counts.tolist()) + 1) < 1 << 61 else object
    top, counts = sizes.astype(kind), counts.astype(kind)
    n, total = np.zeros(m + 1, kind), np.zeros(m + 1, kind)
    n[1:], total[1:] = np.cumsum(counts), np.cumsum(counts * top)
    # No bucket yet: nothing is packed, and more than any padding for the rest.
    best = np.full(m + 1, int(top[-1]) * int(n[-1]) + 1, kind)
    best[0] = 0
    back = []
    for _ in range(min(buckets, m)):
        best, at = _cheapest(best, top, n, total)
        back.append(at.astype(np.int32))
        if best[m] == 0:
            break
    ends, j = set(), m
    for at in reversed(back):
        if j:
            ends.add(int(top[j - 1]))
            j = int(at[j])
    return sorted(ends), int(best[m])


def _program(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if rows:
            sizes, counts = (np.concatenate(x) for x in zip(*rows, strict=True))
            order = np.argsort(sizes)
            yield pa.RecordBatch.from_arrays([pa.array(boundaries(sizes[order], counts[order], buckets)[0], pa.int64())], ["bucket_len"])

    return run


def _bucket_of(value: Column, ends: list[int]) -> Column:
    """The first boundary that the value does not exceed."""
    place = F.lit(ends[-1]) if ends else F.lit(0)
    for end in reversed(ends[:-1]):
        place = F.when(value <= end, F.lit(end)).otherwise(place)
    return place.cast("long")


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, length: Column | None = None) -> DataFrame:
    """docs and n_tokens, bucket_len (the padded length), batch (a number inside the bucket) and slot (the place
    in the batch). length: tokens of a row; by default those of a byte-level model."""
    docs = docs.drop("n_tokens", "bucket_len", "batch", "slot")
    shards = 1 + docs.count() // SHARD_ROWS
    sized = docs.withColumn("n_tokens", F.coalesce(byte_tokens(F.col("text")) if length is None else length.cast("long"), F.lit(0)))
    histogram = sized.groupBy("n_tokens").agg(F.count("*").alias("n"))
    ends = sorted(r["bucket_len"] for r in histogram.repartition(1).mapInArrow(_program(buckets), "bucket_len long").collect())
    shard = F.pmod(F.xxhash64("doc_id", "n_tokens", "text"), F.lit(shards))
    keyed = sized.withColumn("bucket_len", _bucket_of(F.col("n_tokens"), ends)).withColumn("__shard", shard)
    sizes = keyed.groupBy("bucket_len", "__shard").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("bucket_len").orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("bucket_len", "__shard", F.coalesce(before, F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("bucket_len", "__shard").orderBy("doc_id", "n_tokens")) - 1
    numbered = keyed.withColumn("__at", inside).join(offsets, ["bucket_len", "__shard"])
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1))))
    at = F.col("__at") + F.col("__before")
    return numbered.withColumn("batch", F.floor(at / room)).withColumn("slot", F.pmod(at, room).cast("long")).select(
        *docs.columns, "n_tokens", "bucket_len", "batch", "slot"
    )


def report(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Per document: doc_id, n_tokens, bucket_len, batch, slot."""
    return pack(docs.select("doc_id", "text"), buckets, budget).drop("text")
