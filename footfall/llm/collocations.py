"""Phrase collocations: pairs and triples of words that occur together more than their parts explain.

Candidates are found level by level and are Apriori-safe: a phrase can be frequent only if its words are, and a
triple only if both its pairs are. Each level counts 64-bit hashes of the phrases that may be frequent; those whose
hash reaches LEAST go on. A hash counts at least what each of its phrases does, so none is lost.

One more scan, however many candidates there are, names the phrases that the levels leave: a task gives each once
for about HELD of them, with how often it stood there, packed by language and part of the hashes. Such a part holds
all that the tasks met of its phrases. It is one group, which makes double-array tries of SHARD candidates at most:
language, then words, one state each. numpy moves the states of all phrases of a slice at once, a level a step; the
accepting states are binned and counted, packed by BLOCK candidates and added up. So no task and no broadcast holds
all candidates, and the work grows with the texts, not with texts times tries.

Levels are pruned by bitmaps over the frequent hashes, of 2^BITS bits and for many hashes up to 2^MORE times as many;
a full bitmap prunes less and loses nothing. Counts are combined in the tasks before they are shuffled, so a frequent
word or phrase is few rows.

Defined results: null texts count as empty; a null language is `und`; empty tables give no row; repeated rows
count each time; ids and other columns play no part; a text without words counts nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.llm.tables import stored, stored_alone
from footfall.llm.text import LOWER_CODES, SLICE_BYTES, Hasher, Slice, mix, slices

LEAST = 10
INSIDE = 50
TOP = 2000
SHARD = 1 << 18
TRIES = 8
BLOCK = 1 << 12
GROUPS, HELD = 1024, 1 << 19
DIGIT, DIGITS = 1024, 2
BITS, MORE = 24, 2

# The bytes that end a piece, and those that part words.
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_BLANKS = b" \t"

_BREAK = np.zeros(256, bool)
_BREAK[list(_BREAKS)] = True
_WORD = ~_BREAK
_WORD[list(_BLANKS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Tokens:
    """The words of a slice: their language's number, whether the next one follows in the same piece, and, worked out
    where they are asked for, hashes (of word and language) and the words as a dictionary."""

    def __init__(self, part: Slice, languages: np.ndarray, names: list[str], times: np.ndarray | None = None) -> None:
        """times: where the texts are phrases, how often each stands."""
        self._part, self._names = part, names
        inside = np.zeros(len(part.data) + 2, bool)
        inside[1:-1] = _WORD[part.data]
        fresh = part.starts_document()
        now, before = inside[1:], inside[:-1]
        self.starts = np.flatnonzero(now & (~before | fresh))
        self.ends = np.flatnonzero(before & (~now | fresh))
        bounds = np.searchsorted(self.starts, part.offsets)
        self.language = np.repeat(languages, np.diff(bounds))
        breaks = np.flatnonzero(_BREAK[part.data])
        ending = np.searchsorted(breaks, self.starts)
        self.follows = np.zeros(len(self.starts), bool)
        self.follows[:-1] = ending[1:] == ending[:-1]
        last = bounds[1:][np.diff(bounds) > 0] - 1
        self.follows[last] = False
        self.times = None
        if times is not None:
            self.times = np.zeros(len(self.starts), np.int64)
            self.times[bounds[:-1][np.diff(bounds) > 0]] = times[np.diff(bounds) > 0]

    def __len__(self) -> int:
        return len(self.starts)

    @cached_property
    def hashes(self) -> np.ndarray:
        if not len(self):
            return np.empty(0, np.uint64)
        salts = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self._names]
        own = Hasher(self._part.data, LOWER_CODES).ranges(self.starts, self.ends)
        return mix(own ^ np.array(salts, np.uint64)[self.language])

    @cached_property
    def coded(self) -> pa.DictionaryArray:
        offsets = np.zeros(len(self) + 1, np.int32)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        text = _LOWER[self._part.data[_WORD[self._part.data]]]
        return pa.Array.from_buffers(pa.string(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(text)]).dictionary_encode()

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        parts = [self.coded.dictionary.take(self.coded.indices.take(pa.array(at + k))) for k in range(size)]
        return pc.binary_join_element_wise(*parts, " ")


def _read(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[Tokens, list[str]]]:
    """Tokens of slices of (lang, text) or (lang, phrase, times), and the names of the languages."""
    for batch in batches:
        times = batch.column(2).to_numpy() if batch.num_columns > 2 else None
        coded = batch.column(0).fill_null("und").dictionary_encode()
        names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        for part in slices(batch.column(1), limit):
            here = slice(part.first, part.last)
            yield Tokens(part, codes[here], names, None if times is None else times[here]), names


def _keys(tokens: Tokens, size: int) -> np.ndarray:
    """Hash of the `size` words from each position on."""
    out = tokens.hashes[: max(len(tokens.hashes) - size + 1, 0)].copy()
    for k in range(1, size):
        out *= _STEP
        out += tokens.hashes[k : k + len(out)]
    return mix(out + np.uint64(size))


def _together(tokens: Tokens, size: int) -> np.ndarray:
    """Whether the `size` words from each position on are of one piece."""
    n = max(len(tokens) - size + 1, 0)
    out = np.ones(n, bool)
    for k in range(size - 1):
        out &= tokens.follows[k : k + n]
    return out


def _bits(n: int) -> int:
    """How many bits number n things."""
    return max(n - 1, 0).bit_length()


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - _bits(len(bits) << 6))
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _possible(tokens: Tokens, size: int, maps: list[np.ndarray]) -> np.ndarray:
    """Positions of phrases of `size` words whose shorter phrases may all be frequent."""
    good = _together(tokens, size)
    shorter = _has(maps[size - 2], _keys(tokens, size - 1))
    return good & shorter[: len(good)] & shorter[1 : len(good) + 1]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tokens, names in _read(batches):
        if not len(tokens):
            continue
        coded = tokens.coded
        key = tokens.language.astype(np.int64) * len(coded.dictionary) + coded.indices.to_numpy()
        found, first, counts = np.unique(key, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names).take(pa.array(found // len(coded.dictionary))),
                coded.dictionary.take(pa.array(found % len(coded.dictionary))),
                pa.array(_keys(tokens, 1)[first].view(np.int64)),
                pa.array(counts),
            ],
            ["lang", "phrase", "h", "c"],
        )


def _screen(size: int, maps) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Hashes of the phrases of `size` words that may be frequent, and how often each was seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held or [np.empty(0, np.uint64)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "c"])

        for tokens, _ in _read(batches):
            held.append(_keys(tokens, size)[_possible(tokens, size, maps.value)])
            if sum(map(len, held)) > 1 << 21:
                yield counted()
                held = []
        yield counted()

    return run


_NAMES = "part int, lang string, phrase array<string>, h array<long>, times array<int>"


def _unseen() -> np.ndarray:
    """At each place a hash that falls elsewhere."""
    out = np.arange(1 << 20, dtype=np.uint64)
    out ^= np.uint64(1)
    return out


def _name(maps) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The phrases whose hashes may be frequent, and how often each stands in as many texts of a task as hold about HELD of
    them. A row holds those of one language and one of GROUPS parts of the hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _unseen()  # at each place the last hash that fell there
        held: list[tuple[pa.Array, pa.Array, np.ndarray]] = []
        stood: list[tuple[np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            tongue, phrase = (pa.concat_arrays([x[k] for x in held]) for k in (0, 1))
            h, chosen = np.unique(np.concatenate([x[2] for x in held]), return_index=True)
            held.clear()
            times = np.zeros(len(h), np.int32)
            for keys, counts in stood:
                times[np.searchsorted(h, keys)] += counts
            stood.clear()
            tongue = tongue.take(pa.array(chosen)).dictionary_encode()
            group = (h // np.uint64(2**64 // GROUPS)).astype(np.int64) * len(tongue.dictionary) + tongue.indices.to_numpy()
            order = np.argsort(group, kind="stable")
            found, first = np.unique(group[order], return_index=True)
            bounds = pa.array([*first.tolist(), len(order)], pa.int32())
            columns = [
                pa.array((found // len(tongue.dictionary)).astype(np.int32)),
                tongue.dictionary.take(pa.array(found % len(tongue.dictionary))),
                pa.ListArray.from_arrays(bounds, phrase.take(pa.array(chosen[order]))),
                *(pa.ListArray.from_arrays(bounds, pa.array(x[order])) for x in (h.view(np.int64), times)),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "lang", "phrase", "h", "times"])

        for tokens, names in _read(batches, SLICE_BYTES // 4):
            for size in range(2, len(maps.value) + 1):
                at = np.flatnonzero(_possible(tokens, size, maps.value))
                keys = _keys(tokens, size)[at]
                good = _has(maps.value[size - 1], keys)
                keys, first, counts = np.unique(keys[good], return_index=True, return_counts=True)
                stood.append((keys, counts.astype(np.int32)))
                place = (keys & np.uint64(len(seen) - 1)).astype(np.int64)
                fresh = seen[place] != keys
                seen[place] = keys
                at, keys = at[good][first[fresh]], keys[fresh]
                if len(at):
                    held.append((pa.array(names, pa.string()).take(pa.array(tokens.language[at])), tokens.phrases(at, size), keys))
            if sum(len(x[2]) for x in held) > HELD or sum(len(x[0]) for x in stood) > 4 * HELD:
                yield packed()
                seen = _unseen()
        if held:
            yield packed()

    return run


def _once(group: pa.Table) -> pa.Table:
    """Each phrase of a language and part of the hashes once."""
    rows = pa.table([pc.list_flatten(group["phrase"]), pc.list_flatten(group["h"])], names=["phrase", "h"])
    rows = rows.group_by(["phrase", "h"]).aggregate([])
    return pa.table([pa.repeat(group["lang"][0], len(rows)), rows["phrase"], rows["h"]], names=["lang", "phrase", "h"])


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """2^BITS bits or, for many hashes, up to 2^MORE times as many, set where a hash begins with that number."""
    bits = min(max(_bits(16 * hashes.count()), BITS), BITS + MORE)
    at = f"shiftrightunsigned(h, {64 - bits})"
    words = hashes.selectExpr(f"shiftright({at}, 6) as word", f"shiftleft(1L, cast({at} & 63 as int)) as bit")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


# --- tries ----------------------------------------------------------------------------------------------------


@dataclass
class Trie:
    """A double array: the state after state s by symbol c is base[s] + c, if check there is s. State 1 is the root, 0
    dead. A language is one symbol, a word DIGITS of them: its number written to the base DIGIT, so that no state has
    more than DIGIT children and all find their place close by. accept: the phrase that ends at a state, or -1."""

    languages: pa.Array
    words: pa.Array
    lang: pa.Array
    phrase: pa.Array
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        to = self.base[states] + symbols
        good = (states > 0) & (symbols > 0) & (to > 0) & (to < len(self.check))
        to = np.where(good, to, 0)
        return np.where(self.check[to] == states, to, 0)

    def word(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The states after a whole word each, -1 for a word that is not in this trie."""
        for digit in _digits(words):
            states = self.step(states, np.where(words < 0, 0, digit))
        return states

    def count(self, tokens: Tokens, names: list[str], into: np.ndarray) -> None:
        """Add the occurrences of all phrases in the texts to `into`; where the texts are phrases, those of whole texts."""
        langs = pc.index_in(pa.array(names, pa.string()), value_set=self.languages).fill_null(-1).to_numpy() + 1
        found = pc.index_in(tokens.coded.dictionary, value_set=self.words).fill_null(-1).to_numpy()
        start = self.step(np.ones(len(langs), np.int64), langs)
        # What a first word leads to is looked up once for each word and language of the slice.
        first = np.stack([self.word(np.full(len(found), s), found) for s in start]) if len(start) else np.zeros((1, 0), np.int64)
        index = tokens.coded.indices.to_numpy()
        state = first[tokens.language, index]
        at = np.flatnonzero((state > 0) & tokens.follows & (True if tokens.times is None else tokens.times > 0))
        state = state[at]
        for level in (1, 2):
            state = self.word(state, found[index[at + level]])
            hits = self.accept[state]
            if tokens.times is None:
                into += np.bincount(hits[hits >= 0], minlength=len(into))
            else:
                whole = (hits >= 0) & ~tokens.follows[at + level]
                into += np.bincount(hits[whole], tokens.times[at[whole]], len(into)).astype(np.int64)
            alive = (state > 0) & tokens.follows[at + level]
            at, state = at[alive], state[alive]


def _digits(numbers: np.ndarray) -> list[np.ndarray]:
    """Numbers as DIGITS symbols from 1 on."""
    return [numbers // DIGIT ** (DIGITS - 1 - k) % DIGIT + 1 for k in range(DIGITS)]


def double_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and accept of distinct rows of symbols (0 after the end). States with many children find their place
    first, near the end if nowhere else; those with one take what is free."""
    rng = np.random.default_rng(11)
    wide = int(symbols.max(initial=0)) + 1
    base, check, accept = np.zeros(4 * wide, np.int32), np.full(4 * wide, -1, np.int32), np.full(4 * wide, -1, np.int32)
    check[:2] = 0
    slot = np.ones(len(symbols), np.int64)  # where each row's walk has come

    def grow(more: int) -> None:
        nonlocal base, check, accept
        base, check, accept = (np.concatenate([x, np.full(more, fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (accept, -1)))

    for level in range(symbols.shape[1]):
        going = np.flatnonzero(symbols[:, level])
        keys, back = np.unique(slot[going] * wide + symbols[going, level], return_inverse=True)
        above, codes = keys // wide, keys % wide
        parents, first, counts = np.unique(above, return_index=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        several = int((counts > 1).sum())
        free, tried = np.flatnonzero(check == -1), 0
        for k in order[:several].tolist():
            mine = codes[first[k] : first[k] + counts[k]]
            tried += 1
            if tried % 256 == 0:
                free = np.flatnonzero(check == -1)
            tries = free[rng.integers(0, len(free), 48)] - mine[0]
            tries = tries[(tries + mine[0] > 1) & (tries + mine[-1] < len(check))]
            fits = (check[tries[:, None] + mine] == -1).all(1)
            if fits.any():
                b = int(tries[fits.argmax()])
            else:
                b = len(check) - int(mine[0])
                grow(max(4 * wide, len(check) // 8))
                free = np.flatnonzero(check == -1)
            base[parents[k]] = b
            check[b + mine] = parents[k]
        single = order[several:]
        lacking = len(single) - int((check == -1).sum())
        if lacking > 0:
            grow(lacking + wide)
        free = np.flatnonzero(check == -1)[: len(single)]
        base[parents[single]] = free - codes[first[single]]
        check[free] = parents[single]
        slot[going] = (base[above] + codes)[back]
    accept[slot] = np.arange(len(symbols))
    return base, check, accept


def build_trie(lang: pa.Array, phrase: pa.Array) -> Trie:
    tongues = lang.dictionary_encode()
    split = pc.split_pattern(phrase, " ")
    words = split.flatten().dictionary_encode()
    sizes = pc.list_value_length(split).to_numpy()
    symbols = np.zeros((len(phrase), 1 + 3 * DIGITS), np.int64)
    symbols[:, 0] = tongues.indices.to_numpy() + 1
    row = np.repeat(np.arange(len(phrase)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for k, digit in enumerate(_digits(words.indices.to_numpy())):
        symbols[row, 1 + DIGITS * place + k] = digit
    return Trie(tongues.dictionary, words.dictionary, lang, phrase, *double_array(symbols))


_COUNTS = "trie int, block int, at binary, counts binary"


def _count(tries) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task counts in its texts: for each trie and BLOCK of its candidates which of them it met, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(len(t.phrase), np.int64) for t in tries.value]
        for tokens, names in _read(batches):
            for trie, total in zip(tries.value, totals, strict=True):
                trie.count(tokens, names, total)
        for k, total in enumerate(totals):
            at = np.flatnonzero(total)
            blocks, first = np.unique(at // BLOCK, return_index=True)
            parts = np.split(at, first[1:]) if len(at) else []
            packed = [[x.tobytes() for x in some] for some in ([(p % BLOCK).astype(np.uint16) for p in parts], [total[p] for p in parts])]
            columns = [np.full(len(blocks), k, np.int32), blocks.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *(pa.array(x, pa.binary()) for x in packed)], ["trie", "block", "at", "counts"])

    return run


def _add_up(tries) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The phrases of some blocks and the sums of all tasks; rows of a block are in one task, which holds 8 bytes a candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, block, at, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = totals.setdefault((k, block), np.zeros(BLOCK, np.int64))
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(counts, np.int64)
        for (k, block), total in totals.items():
            trie, at = tries.value[k], np.flatnonzero(total)
            named = pa.array(at + block * BLOCK)
            yield pa.RecordBatch.from_arrays([trie.lang.take(named), trie.phrase.take(named), pa.array(total[at])], ["lang", "phrase", "f"])

    return run


@dataclass
class _Held:
    """Tries that a task has made itself, where others take theirs from a broadcast."""

    value: list[Trie]


def _tally(least: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        """lang, phrase, f of one language and part of the hashes: the phrases whose hash was met `least` times or more."""
        phrase, h, times = (pc.list_flatten(group[c]).combine_chunks() for c in ("phrase", "h", "times"))
        keys, at = np.unique(h.to_numpy(), return_inverse=True)
        often = np.bincount(at, times.to_numpy()) >= least
        named, lang = _once(group), group["lang"][0]
        named = named["phrase"].filter(pc.is_in(named["h"], pa.array(keys[often]))).cast(pa.string()).combine_chunks()
        named, good = named.take(pc.sort_indices(named)), pa.array(often[at])
        met = [phrase.filter(good).cast(pa.string()), times.filter(good)]
        met = pa.RecordBatch.from_arrays([pa.repeat(lang, len(met[0])).cast(pa.string()), *met], ["lang", "phrase", "times"])
        found = [pa.table([pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.int64())], names=["lang", "phrase", "f"])]
        for first in range(0, len(named), TRIES * SHARD):
            shards = [named.slice(k, SHARD) for k in range(first, min(first + TRIES * SHARD, len(named)), SHARD)]
            tries = _Held([build_trie(pa.repeat(lang, len(x)).cast(pa.string()), x) for x in shards])
            found += map(pa.Table.from_batches, ([x] for x in _add_up(tries)(_count(tries)(iter([met])))))
        return pa.concat_tables(found)

    return run


def count_phrases(texts: DataFrame, maps, least: int) -> DataFrame:
    """lang, phrase, f for the phrases that the bitmaps leave and texts (lang, text) hold `least` times or more, in one scan
    of the texts: tasks name what they meet, and a trie of each part of the hashes counts it, so that no task holds all
    candidates."""
    met = texts.mapInArrow(_name(maps), _NAMES).groupBy("part", "lang")
    return met.applyInArrow(_tally(least), "lang string, phrase string, f long").where(F.col("f") >= least)


# --- mining ---------------------------------------------------------------------------------------------------


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = 3) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to `longest` (3 at most) words that occur `least` times or more (lang, phrase, size, f), and the
    words of each language (lang, n)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    words = texts.mapInArrow(_count_words, "lang string, phrase string, h long, c long")
    words = words.groupBy("lang", "phrase").agg(F.sum("c").alias("f"), F.first("h").alias("h"))
    # Rare words are one row of each language, without phrase.
    often = F.when(F.col("f") >= least, F.col("phrase")).alias("phrase")
    words = stored(words.groupBy("lang", often).agg(F.sum("f").alias("f"), F.first("h").alias("h")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where("phrase is not null")
    maps = [_bitmap(frequent)]
    for size in range(2, longest + 1):
        shared = spark.sparkContext.broadcast(maps)
        counted = texts.mapInArrow(_screen(size, shared), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
        maps = [*maps, _bitmap(stored(counted.where(F.col("c") >= least).select("h"), "hashes"))]
    counted = count_phrases(texts, spark.sparkContext.broadcast(maps), least)
    size = F.size(F.split("phrase", " ")).alias("size")
    found = frequent.select("lang", "phrase", F.lit(1).alias("size"), "f").unionByName(counted.select("lang", "phrase", size, "f"))
    return found, totals


def scored(found: DataFrame, inside: int = INSIDE) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases of two words or more (lang, phrase, size, f) that no longer one
    explains: the cut with the lowest score counts."""
    phrases = found.where("size > 1")
    words = F.split("phrase", " ")

    def part(first: Column, count: Column) -> Column:
        return F.array_join(F.slice(words, first, count), " ")

    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("size")).alias("tail"))
    known = found.where("size < 3")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    # 18 digits each: exact up to a of 10^16, far beyond any corpus.
    big = "cast({0} as decimal(18,0)) * cast({1} as decimal(18,0))"
    score = F.expr(f"cast(1000000 as decimal(7,0)) * ({big.format('a', 'a')}) div ({big.format('l', 'r')})")
    best = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    parts = F.explode(F.array(part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1)))
    longer = phrases.where("size = 3").select("lang", parts.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    return kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def report(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first `top` phrases by score, then frequency, then bytes: lang, rank, phrase, a, l, r, n, score."""

    def mine() -> DataFrame:
        found, totals = frequent_phrases(docs)
        found = stored(found, "found")
        by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        first = scored(found).withColumn("rank", F.row_number().over(by_score).cast("long")).where(F.col("rank") <= top)
        return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

    return stored_alone(docs.sparkSession, mine, "collocations")
