"""Document fingerprints by spot signatures.

Common words are anchors; each anchor with the chain of the CHAIN content words that follow it is a signature,
so a document's set follows its prose and not its frame. The fingerprint is the sorted set, eight hexadecimal
digits a signature; likeness is the Jaccard similarity of two sets, pruned by their lengths: when the shorter
set is too short for the asked similarity, the sets are not walked.

`with_next` sets every document against its edited form (its last half replaced by the beginning of the next
document) and against the next document. Documents are range-partitioned by id and streamed in order, one row
carried along; the first document of each partition is also sent to the partition before it, so every row
meets its successor without a global sort or a second shuffle. Rows that lack an id, and those of an id that
holds several ranges, are dealt on by ranges of the hash of their text.

`near_pairs` joins whole collections: documents with equal sets are one class; classes are partitioned by set
length, so that a pair can only meet inside a length band or its neighbour, and joined on the rarest signatures
of their sets (a pair at the threshold shares one of them, and early); what is left is confirmed by Jaccard. A
signature's list of more than LIST_ROWS classes is cut into blocks, and each two blocks meet on their own. The
op5 query does not use it: `with_next` compares given pairs by plain Jaccard, without a threshold.

Defined results: a text with few chains is fingerprinted by its words, too, one without words by its bytes, so
equal texts always have equal fingerprints and likeness 1; null counts as empty; null ids come first,
rows that share an id, or lack one, are ordered by a hash of their text, then by text; after the last document comes the first (a lone document follows
itself); empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.text import ALNUM, Slice, find_words, grams, mix, slices

CHAIN = 3
#: Texts with fewer signatures carry their words as signatures, too.
FEW = 8
THRESHOLD = 0.75
#: Classes of one signature's list that meet in a block.
LIST_ROWS = 1000

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have in is it its not of on or that the this to was were which with "
    "aber als am auch auf aus bei das dem den der des die ein eine einer es für ich im ist mit nicht sich sie "
    "sind und von wie zu zum zur "
    "au aux avec ce ces cette dans de du elle en est et il la le les mais ne ou par pas plus pour que qui sa "
    "se ses son sur un une "
    "al como con del el ella ese esta esto las los lo más no o para pero por su sus una y ya"
)


def _anchor_hashes() -> np.ndarray:
    words = sorted(set(ANCHORS.split()))
    part = next(slices(pa.array(words)))
    return np.sort(find_words(part, ALNUM).hashes)


def signatures(part: Slice, anchors: np.ndarray) -> list[np.ndarray]:
    """The set of each document: sorted distinct 32-bit signatures."""
    words = find_words(part, ALNUM)
    h, bounds = words.hashes, words.bounds
    at = np.minimum(np.searchsorted(anchors, h), len(anchors) - 1)
    common = anchors[at] == h
    content = np.flatnonzero(~common)
    spots = np.flatnonzero(common)
    follow = np.searchsorted(content, spots)
    row = np.searchsorted(bounds, spots, side="right") - 1
    good = follow + CHAIN <= len(content)
    good[good] = content[follow[good] + CHAIN - 1] < bounds[row[good] + 1]
    spots, follow, row = spots[good], follow[good], row[good]
    chain = grams(h[content], CHAIN)
    found = (mix(h[spots] + chain[follow]) >> np.uint64(32)).astype(np.uint32)
    cuts = np.searchsorted(row, np.arange(len(part) + 1))
    sets = []
    for i in range(len(part)):
        mine = found[cuts[i] : cuts[i + 1]]
        if len(mine) < FEW:
            own = h[bounds[i] : bounds[i + 1]]
            if not len(own):
                own = np.frombuffer(hashlib.blake2b(part.text(i), digest_size=8).digest(), np.uint64)
            mine = np.r_[mine, (own >> np.uint64(32)).astype(np.uint32)]
        sets.append(np.unique(mine))
    return sets


def likeness(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 where their lengths rule `floor` out."""
    small, large = sorted((len(a), len(b)))
    if large == 0 or small < floor * large:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (small + large - common)


def _hex(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (part, tail, id): each row but the last of a part, set against the one after it."""
    anchors = _anchor_hashes()
    held = None  # part, id, text, set of the row before
    for batch in batches:
        parts, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for piece in slices(batch.column(2)):
            sets = signatures(piece, anchors)
            pairs = []
            for i in range(len(piece)):
                row = (parts[piece.first + i], ids[piece.first + i], piece.text(i).decode(), sets[i])
                if held is not None and held[0] == row[0]:
                    pairs.append((held, row))
                held = row
            if not pairs:
                continue
            edited = []
            for one, following in pairs:
                half = len(one[2]) // 2
                edited.append(one[2][: len(one[2]) - half] + following[2][:half])
            out = [s for p in slices(pa.array(edited, pa.large_string())) for s in signatures(p, anchors)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[1] for a, _ in pairs], pa.int64()),
                    pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    pa.array([_hex(a[3]) for a, _ in pairs]),
                    pa.array([_hex(s) for s in out]),
                    pa.array([likeness(a[3], s) for (a, _), s in zip(pairs, out, strict=True)]),
                    pa.array([likeness(a[3], b[3]) for a, b in pairs]),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )


def _dealt(docs: DataFrame, wanted: int) -> tuple[DataFrame, int]:
    """doc_id, text and mark (a hash of the text) with their part, and the number of parts. Parts follow the order of
    (doc_id, mark): ranges of ids between quantiles; an id that holds several quantiles has as many parts of its own,
    ranges of the mark, and so have null ids by their share."""
    docs = docs.withColumn("mark", F.xxhash64("text"))
    shares = [k / wanted for k in range(1, wanted)]
    n, known, borders = docs.agg(F.count("*"), F.count("doc_id"), F.percentile_approx("doc_id", shares, 10_000)).first()
    times = Counter(borders or [])
    edges = sorted(times)
    own = [times[b] if times[b] > 1 else 0 for b in edges]
    nulls = 1 + (n - known) * wanted // max(n, 1)
    starts = [nulls, *(nulls + k + 1 + w for k, w in enumerate(itertools.accumulate(own)))]

    def listed(values: list[int]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<long>")

    def inside(parts: Column) -> Column:
        return F.least(F.floor((F.col("mark") / F.lit(2.0**64) + F.lit(0.5)) * parts), parts - 1)

    at = F.size(F.filter(listed(edges), lambda b: b < F.col("doc_id")))
    start, several = F.get(listed(starts), at), F.get(listed(own), at)
    crowded = (F.get(listed(edges), at) == F.col("doc_id")) & (several > 0)
    part = F.when(F.col("doc_id").isNull(), inside(F.lit(nulls))).when(crowded, start + 1 + inside(several)).otherwise(start)
    return docs.select(part.cast("int").alias("part"), "doc_id", "mark", "text"), starts[-1] + 1


def with_next(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt, n = _dealt(docs, max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    firsts = dealt.groupBy("part").agg(F.min(F.struct("doc_id", "mark")).alias("first")).orderBy("part").collect()
    # The first document of each part goes to the part before, the very first one to the last part.
    moves = [(last["part"], now["first"]["doc_id"], now["first"]["mark"]) for last, now in zip([*firsts[-1:], *firsts[:-1]], firsts, strict=True)]
    small = spark.createDataFrame(moves, "to int, of long, by long")
    tails = docs.withColumn("mark", F.xxhash64("text")).join(F.broadcast(small), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("by")))
    tails = tails.groupBy("to", "doc_id", "mark").agg(F.min("text").alias("text"))
    rows = dealt.withColumn("tail", F.lit(0)).unionByName(tails.select(F.col("to").alias("part"), "doc_id", "mark", "text", F.lit(1).alias("tail")))
    rows = rows.repartitionById(n, F.col("part")).sortWithinPartitions("part", "tail", F.col("doc_id").asc_nulls_first(), "mark", "text")
    return rows.select("part", "doc_id", "text").mapInArrow(
        _walk,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = _anchor_hashes()
    for batch in batches:
        for piece in slices(batch.column(1)):
            sets = signatures(piece, anchors)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            bounds = pa.array(np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32))
            values = pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(sets).astype(np.int64)))
            columns = [batch.column(0).slice(piece.first, len(piece)), pa.array(digests, pa.binary()), values]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "class", "signatures"])


def classes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class (a digest of its set), signatures."""
    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(_sets, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, class binary, signatures array<long>")


def _sides(members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join of `near_pairs`, dealt by signature, band and the blocks i (left) and j (right)."""
    one = members.groupBy("class").agg(F.first("signatures").alias("set")).withColumn("n", F.size("set"))
    rows = one.select("class", "n", F.explode("set").alias("s"))
    often = rows.groupBy("s").agg(F.count("*").alias("f"))
    ranked = rows.join(often, "s").groupBy("class", "n").agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("ranked"))
    rare = F.slice("ranked", F.lit(1), (F.col("n") - F.ceil(F.col("n") * threshold) + 1).cast("int"))["s"]
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(1 / threshold)))
    listed = ranked.select("class", "n", band.alias("band"), F.posexplode(rare).alias("at", "s")).join(often.where("f > 1"), "s")
    listed = listed.withColumn("blocks", F.ceil(F.col("f") / LIST_ROWS))
    mine, others = F.pmod(F.xxhash64("class"), F.col("blocks")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    left = listed.select("s", "band", mine.alias("i"), others.alias("j"), F.col("class").alias("a"), F.col("n").alias("na"), F.col("at").alias("ata"))
    right = listed.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"))))
    return left, right.select("s", "band", others.alias("i"), mine.alias("j"), F.col("class").alias("b"), F.col("n").alias("nb"), F.col("at").alias("atb"))


def near_pairs(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of classes (a, b, likeness) at or above the threshold, each once. members: what `classes` returns."""
    left, right = _sides(members, threshold)
    common = F.ceil((F.col("na") + F.col("nb")) * threshold / (1 + threshold))
    early = (F.col("ata") <= F.col("na") - common) & (F.col("atb") <= F.col("nb") - common)
    # Shorter sets are on the left, of equal length the smaller digest.
    ordered = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    pairs = left.join(right, ["s", "band", "i", "j"]).where(ordered & early).select("a", "b").distinct()
    sets = members.groupBy("class").agg(F.first("signatures").alias("set"))
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    like = shared / (F.size("sa") + F.size("sb") - shared)
    return both.select("a", "b", like.alias("likeness")).where(F.col("likeness") >= threshold)
