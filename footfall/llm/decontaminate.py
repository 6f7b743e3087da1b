"""Benchmark decontamination with a generalised suffix automaton over benchmark items.

The automaton reads word hashes. Streaming a document's words through it keeps the length of the longest
match that ends at each word; a match of `window` words or more is contamination, and so is a whole item
of fewer words. Only stretches whose word q-grams all occur in the items are streamed: elsewhere the
matched length provably stays under the shortest window.

Benchmark text does not grow with the corpus, yet its size is checked: it is dealt to shards of about
`shard_bytes`, each with its own automaton. One pass over the documents serves all shards: a task holds
batches of about HELD_BYTES, a sieve of the q-grams of all shards (ten bytes a benchmark word) says which
stretch may match in which shard, and the automata so named are loaded one after the other. A task thus
holds the sieve, one automaton and the held batches, however many shards there are; the driver builds one
automaton at a time. Documents are never collected or shuffled.

Defined results: null and empty texts have no words and are clean; items without a word have no window;
an item without id counts under the empty id; items sharing an id count once; repeated documents are judged alike;
columns other than text and doc_id pass through untouched; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.text import ALNUM, Slice, Words, find_words, grams, slices

WINDOW = 10
SHARD_BYTES = 1 << 20
HELD_BYTES = 1 << 23
#: Documents of which more than this share of words is benchmark text are dropped whole.
MAX_COVERAGE = 0.5

_FOUND = "__found"
_FOUND_TYPE = T.StructType(
    [
        T.StructField("words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


class SuffixAutomaton:
    """All substrings of several sequences of integers."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self._label(items)
        sizes = [len(words) for _, words in items if words]
        self.shortest = min([window, *sizes])

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """A copy of q that holds only the strings reached from p."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def _label(self, items: list[tuple[str, list[int]]]) -> None:
        """Which items hold the strings of a state; which short items end there as a whole."""
        self.items: list[set[str]] = [set() for _ in self.length]
        self.whole: dict[int, list[tuple[int, str]]] = {}
        for name, words in items:
            v = 0
            for w in words:
                v = self.next[v][w]
                u = v
                while u > 0 and name not in self.items[u]:
                    self.items[u].add(name)
                    u = self.link[u]
            if words and len(words) < self.window:
                self.whole.setdefault(v, []).append((len(words), name))
        self.above = [-1] * len(self.length)  # the nearest state, itself included, where a short item ends
        for v in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.above[v] = v if v in self.whole else self.above[self.link[v]]

    def stream(self, words: list[int], names: set[str]) -> list[tuple[int, int]]:
        """Word ranges covered by windows, possibly overlapping; adds the items' names."""
        hits, v, size = [], 0, 0
        following, link, length, window = self.next, self.link, self.length, self.window
        for i, w in enumerate(words):
            while v and w not in following[v]:
                v = link[v]
                size = length[v]
            v = following[v].get(w, 0)
            size = size + 1 if v else 0
            if size >= window:
                hits.append((i + 1 - window, i + 1))
                u = v
                while length[link[u]] >= window:
                    u = link[u]
                names |= self.items[u]
            u = self.above[v]
            while u > 0:
                for m, name in self.whole[u]:
                    if m <= size:
                        hits.append((i + 1 - m, i + 1))
                        names.add(name)
                u = self.above[link[u]]
        return hits


class Sieve:
    """The word q-grams of the shards that share a q, and which shards hold each."""

    #: Grams that are set against their shards at once.
    CHUNK = 1 << 22

    def __init__(self, q: int, known: dict[int, np.ndarray], shortest: dict[int, int]) -> None:
        self.q = q
        every = np.concatenate(list(known.values()))
        owners = np.repeat(np.array(list(known), np.int32), [len(k) for k in known.values()])
        order = np.argsort(every, kind="stable")
        self.grams, first = np.unique(every[order], return_index=True)
        self.first, self.owners = np.r_[first, len(every)], owners[order]
        self.shortest = np.zeros(max(known) + 1, np.int64)
        self.shortest[list(known)] = [shortest[k] for k in known]
        self.least = min(shortest[k] for k in known)
        self.shift = np.uint64(64 - min(26, max(20, 3 + len(self.grams).bit_length())))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[(self.grams >> self.shift).astype(np.int64)] = True

    def stretches(self, words: Words) -> Iterator[tuple[int, int, int, int]]:
        """Shard, row and word range of all stretches whose q-grams the shard holds and that are long enough."""
        g = grams(words.hashes, self.q)
        at = np.flatnonzero(self.bits[(g >> self.shift).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.grams, g[at]), len(self.grams) - 1)
        row = np.searchsorted(words.bounds, at, side="right") - 1
        keep = (self.grams[place] == g[at]) & (at + self.q <= words.bounds[row + 1])
        at, row, place = at[keep], row[keep], place[keep]
        if not len(at):
            return
        # Runs over all shards first: few are long enough, and only their grams are set against the shards.
        run = np.cumsum(np.r_[True, (np.diff(at) > 1) | (np.diff(row) > 0)]) - 1
        keep = np.bincount(run)[run] + self.q - 1 >= self.least
        at, row, place, run = at[keep], row[keep], place[keep], run[keep]
        if not len(at):
            return
        owned = self.first[place + 1] - self.first[place]
        total = np.r_[0, np.cumsum(owned)]
        ends = np.r_[np.flatnonzero(np.diff(run)) + 1, len(run)]
        begin = 0
        while begin < len(at):
            k = np.searchsorted(total[ends], total[begin] + self.CHUNK, side="right") - 1
            end = int(ends[max(k, np.searchsorted(ends, begin, side="right"))])
            n = owned[begin:end]
            gram = np.repeat(np.arange(begin, end), n)
            shard = self.owners[self.first[place[gram]] + np.arange(len(gram)) - np.repeat(total[begin:end] - total[begin], n)]
            order = np.lexsort((gram, shard))
            gram, shard = gram[order], shard[order]
            first = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (at[gram[1:]] != at[gram[:-1]] + 1) | (row[gram[1:]] != row[gram[:-1]])])
            last = np.r_[first[1:], len(gram)] - 1
            lo, hi, owner = at[gram[first]], at[gram[last]] + self.q, shard[first]
            some = hi - lo >= self.shortest[owner]
            yield from zip(owner[some].tolist(), row[gram[first]][some].tolist(), lo[some].tolist(), hi[some].tolist(), strict=True)
            begin = end


def shards(benchmark: DataFrame, window: int, shard_bytes: int) -> Iterator[tuple[SuffixAutomaton, int, np.ndarray]]:
    """Automata of the items, dealt by their text so that each holds about `shard_bytes`, with their q-grams."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // shard_bytes
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        words = []
        for row in rows:
            part = next(slices(pa.array([row["text"]])))
            found = find_words(part, ALNUM).hashes
            if len(found):
                words.append((row["id"], found))
        if words:
            q = min(4, window, *(len(w) for _, w in words))
            known = np.unique(np.concatenate([grams(w, q) for _, w in words]))
            yield SuffixAutomaton([(name, w.tolist()) for name, w in words], window), q, known


def _joined(hits: dict[int, tuple[int, int]]) -> list[int]:
    """Byte ranges of hit words, those of neighbouring words as one: start, end, ..."""
    spans: list[int] = []
    last = None
    for w in sorted(hits):
        if last is not None and w == last + 1:
            spans[-1] = hits[w][1]
        else:
            spans += hits[w]
        last = w
    return spans


def _walk(automata: list, sieves, column: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the matches of all shards to the rows: number of words, hit ranges of bytes, item names, number of hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: int | None = None

        def shard(k: int) -> SuffixAutomaton:
            nonlocal loaded
            if loaded is not None and loaded != k:
                vars(automata[loaded]).pop("_value", None)  # a worker keeps the automaton it read last, and no other
            loaded = k
            return automata[k].value

        def settle(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Of a slice's words only their numbers and the open stretches are kept.
            n_words: list[list[int]] = [[] for _ in held]
            todo: dict[int, list] = defaultdict(list)
            for b, batch in enumerate(held):
                for part in slices(batch.column(batch.schema.get_field_index(column))):
                    words = find_words(part, ALNUM)
                    for sieve in sieves.value:
                        for k, row, lo, hi in sieve.stretches(words):
                            bytes_ = np.stack([words.starts[lo:hi], words.ends[lo:hi]]) - part.offsets[row]
                            todo[k].append((b, part.first + row, lo - words.bounds[row], words.hashes[lo:hi].copy(), bytes_))
                    n_words[b] += np.diff(words.bounds).tolist()
            hits, items = defaultdict(dict), defaultdict(set)
            for k in sorted(todo):
                automaton = shard(k)
                for b, row, first, hashes, bytes_ in todo[k]:
                    names: set[str] = set()
                    for s, e in automaton.stream(hashes.tolist(), names):
                        for w in range(s, e):
                            hits[b, row][first + w] = (int(bytes_[0, w]), int(bytes_[1, w]))
                    items[b, row] |= names
            kind = pa.struct([("words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
            for b, (batch, counts) in enumerate(zip(held, n_words, strict=True)):
                rows = [
                    {"words": n, "spans": _joined(hits[b, i]) if (b, i) in hits else [], "items": sorted(items[b, i]) if (b, i) in items else []}
                    for i, n in enumerate(counts)
                ]
                n_hit = pa.array([len(hits[b, i]) if (b, i) in hits else 0 for i in range(len(counts))], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind), n_hit], [*batch.schema.names, _FOUND, _FOUND + "_hits"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(batch.schema.get_field_index(column)).nbytes
            if size >= HELD_BYTES:
                yield from settle(held)
                held, size = [], 0
        yield from settle(held)

    return run


def _walker(spark: SparkSession, benchmark: DataFrame, window: int, shard_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    automata: list = []
    known: dict[int, dict[int, np.ndarray]] = defaultdict(dict)
    shortest = {}
    for k, (automaton, q, own) in enumerate(shards(benchmark, window, shard_bytes)):
        automata.append(spark.sparkContext.broadcast(automaton))
        known[q][k], shortest[k] = own, automaton.shortest
    sieves = spark.sparkContext.broadcast([Sieve(q, own, shortest) for q, own in sorted(known.items())])
    return _walk(automata, sieves, "text")


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """The rows of docs with `__found` (words; byte spans as start, end, ...; item ids) and `__found_hits` (words hit)."""
    schema = T.StructType([*docs.schema.fields, T.StructField(_FOUND, _FOUND_TYPE), T.StructField(_FOUND + "_hits", T.LongType())])
    return docs.mapInArrow(_walker(docs.sparkSession, benchmark, window, shard_bytes), schema)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per document: words, hit words, items with occurring windows, and whether anything was hit."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark, window, shard_bytes)
    items = F.col(_FOUND)["items"]
    return found.select(
        "doc_id",
        F.col(_FOUND)["words"].alias("n_words"),
        F.col(_FOUND + "_hits").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col(_FOUND + "_hits") > 0).alias("contaminated"),
    )


def _cut(batch: pa.RecordBatch, max_coverage: float) -> pa.RecordBatch:
    """The rows of a batch with matches that are kept, without the matching spans."""
    found, hits = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
    text = batch.schema.get_field_index("text")
    cut = {}
    for i, row in enumerate(found):
        if row["spans"] and hits[i] <= max_coverage * row["words"]:
            raw, at, kept = batch.column(text)[i].as_py().encode(), 0, []
            for a, b in zip(row["spans"][::2], row["spans"][1::2], strict=True):
                kept.append(raw[at:a])
                at = b
            cut[i] = b"".join([*kept, raw[at:]]).decode()
    columns, names = batch.columns[:-2], batch.schema.names[:-2]
    if cut:
        columns[text] = pa.array([cut[i] if i in cut else t.as_py() for i, t in enumerate(columns[text])], columns[text].type)
    out = pa.RecordBatch.from_arrays(columns, names)
    keep = [n <= max_coverage * row["words"] for n, row in zip(hits, found, strict=True)]
    return out if all(keep) else out.filter(pa.array(keep))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """docs without benchmark text: spans of at least a window are cut out of the text, and a document goes when
    more than `max_coverage` of its words were hit. Columns as given; a column n_chars follows the text."""
    walk = _walker(docs.sparkSession, benchmark, window, shard_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in walk(batches):
            yield _cut(batch, max_coverage)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind))
    return out
