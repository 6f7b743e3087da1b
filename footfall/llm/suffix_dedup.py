"""Exact substring dedup with suffix arrays built by linear grouping.

A byte goes when a string of LENGTH bytes that covers it also starts earlier (smaller doc_id, or the same
document further left). All strings are judged on the input.

Finding who may be equal. Every string of LENGTH bytes has one anchor: its GRAM-byte piece with the smallest
hash, the leftmost of equals. Equal strings have equal anchors at equal places, so only occurrences of one
anchor need comparing, and all strings of an anchor lie in its context: LENGTH - GRAM bytes before it to
LENGTH bytes from it. Documents are dealt by id and text to blocks of about BLOCK_BYTES, so rows that lack or
share an id are spread; places are ordered by (id, block, offset). A block reports each distinct
(anchor, context) once, so that copies are summed up before the shuffle. A block is hashed in pieces of
PIECE_BYTES, long texts too: an anchor depends on its string alone. Sorted by anchor, context and place,
the reports show in one streaming pass which contexts are whole copies of an earlier one, which anchors are
unique, and which anchors have different contexts. Only the last need their bytes.

Comparing different contexts. The contexts of a batch of anchors become one text over symbols of GRAM bytes
(ranks of the byte strings): for each context its right side from the anchor and its left side read backwards.
`suffix_array` sorts all its suffixes by linear grouping: groups of suffixes with the same Lyndon prefix are
processed in descending order, each moving the previous smaller suffixes of its members to new groups right
above their old ones; then the groups' order is emitted from the smallest suffix on, along the same pointers.
The order and the common lengths of neighbours give, for every r, which contexts agree on the r bytes before
and the LENGTH - r bytes from the anchor, that is, on one string; all but the first go.

An anchor with more than HOT different contexts (say, the edge of a passage that a third of all documents
share) is not gathered: its strings are dealt by their own 128-bit hash and the first of each is found by an
aggregation with partial sums.

Defined results: null and empty texts have no bytes and nothing removed; null ids come before all others;
rows that share an id are ordered by a hash of their text, then by the text, exact repeats arbitrarily; offsets are bytes, so a cut may
split a character. `dedup` keeps the text as binary for that reason. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import stored
from footfall.llm.text import BYTE_CODES, Hasher, mix, slices

LENGTH, GRAM = 100, 32
BEFORE = LENGTH - GRAM
BLOCK_BYTES = 1 << 22
PIECE_BYTES = 1 << 19
BATCH_CONTEXTS = 4096
HOT = 50_000

_FIRST_ID = -(1 << 63)


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes in order. The last symbol must be the only smallest one."""
    n = len(text)
    symbols = np.array(text)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    begin = np.maximum.accumulate(np.where(np.r_[True, ranked[1:] != ranked[:-1]], np.arange(n), 0))
    place, group = np.empty(n, np.int64), np.empty(n, np.int64)
    place[order], group[order] = np.arange(n), begin
    sa, place, group = order.tolist(), place.tolist(), group.tolist()
    size = np.bincount(begin, minlength=n).tolist()
    previous = [-1] * n

    end = n
    while end > 0:  # a group is named by where it starts
        g = group[sa[end - 1]]
        members = sa[g:end]
        end = g
        if len(members) == 1:
            i = members[0]
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                h = group[p]
                size[h] -= 1
                last, at = h + size[h], place[p]
                other = sa[last]
                sa[at], place[other] = other, at
                sa[last], place[p] = p, last
                size[last], group[p] = 1, last
            continue
        members.sort()
        parents: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                parents[p] = parents.get(p, 0) + 1
        levels: dict[int, list[int]] = {}
        for p, times in parents.items():
            levels.setdefault(times, []).append(p)
        for times in sorted(levels, reverse=True) if len(levels) > 1 else levels:
            moved: dict[int, list[int]] = {}
            for p in levels[times]:
                h = group[p]
                size[h] -= 1
                last, at = h + size[h], place[p]
                other = sa[last]
                sa[at], place[other] = other, at
                sa[last], place[p] = p, last
                moved.setdefault(h, []).append(p)
            for h, some in moved.items():
                new = h + size[h]
                size[new] = len(some)
                for p in some:
                    group[p] = new

    done = bytearray(n)
    done[n - 1] = 1
    sa[0] = n - 1
    free = list(range(n))
    for k in range(n):
        j = sa[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            sa[free[g]] = j
            free[g] += 1
            done[j] = 1
            j = previous[j]
    return sa


# ---------------------------------------------------------------- blocks of documents


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a batch that go to one block, as one compressed row."""
    for batch in batches:
        for part in slices(batch.column(2), 1 << 24):
            ids = batch.column(0).slice(part.first, len(part)).to_pylist()
            blocks = batch.column(1).slice(part.first, len(part)).to_numpy()
            names, code = np.unique(blocks, return_inverse=True)
            order = np.argsort(code, kind="stable")
            rows = []
            for b, some in zip(names.tolist(), np.split(order, np.cumsum(np.bincount(code))[:-1]), strict=True):
                texts = [part.text(i) for i in some.tolist()]
                rows.append((b, [ids[i] for i in some.tolist()], [len(t) for t in texts], pa.compress(b"".join(texts), "zstd", asbytes=True)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[3] for r in rows], pa.binary()),
                ],
                ["block", "ids", "sizes", "z"],
            )


class Block:
    """The documents of a block in order, as one byte array."""

    def __init__(self, table: pa.Table) -> None:
        rows = []
        for ids, sizes, z in zip(*(table.column(c).to_pylist() for c in ("ids", "sizes", "z")), strict=True):
            raw, at = pa.decompress(z, sum(sizes), "zstd", asbytes=True) if sum(sizes) else b"", 0
            for doc, size in zip(ids, sizes, strict=True):
                rows.append((doc is not None, doc or 0, raw[at : at + size]))
                at += size
        rows.sort()
        self.number = table.column("block")[0].as_py() if len(table) else None
        self.ids = [doc if known else None for known, doc, _ in rows]
        self.order = np.array([doc if known else _FIRST_ID for known, doc, _ in rows], np.int64)
        self.offsets = np.r_[0, np.cumsum([len(t) for _, _, t in rows], dtype=np.int64)]
        self.data = np.frombuffer(b"".join(t for _, _, t in rows), np.uint8)

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1

    def contexts(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = self.row_of(anchors)
        return np.maximum(anchors - BEFORE, self.offsets[row]), np.minimum(anchors + LENGTH, self.offsets[row + 1])


def anchors_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all anchors, ascending."""
    places, hashes, last = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], -1
    # The place in the low bits makes the leftmost of equal hashes the smallest; a piece has fewer than 2^24.
    low = np.uint64((1 << 24) - 1)
    span = LENGTH - GRAM + 1
    for begin in range(0, len(data) - LENGTH + 1, PIECE_BYTES):  # strings that begin in the piece
        part = data[begin : begin + PIECE_BYTES + LENGTH - 1]
        h, power, width = BYTE_CODES[part], 0x9E3779B97F4A7C15, 1
        while width < GRAM:
            h = h[:-width] * np.uint64(power) + h[width:]
            power, width = power * power % (1 << 64), width * 2
        h = mix(h)
        least, width = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        count = len(part) - LENGTH + 1
        least = np.minimum(least[:count], least[span - width :][:count])
        starts = np.ones(count, bool)  # strings that end in their document
        first, stop = np.searchsorted(offsets[1:-1], (begin + 1, begin + len(part)))
        for at in (offsets[1:-1][first:stop] - begin).tolist():
            starts[max(0, at - LENGTH + 1) : at] = False
        anchor = (least & low).astype(np.int64)[starts]
        if not len(anchor):
            continue
        anchor = anchor[np.r_[anchor[0] + begin != last, anchor[1:] != anchor[:-1]]]
        places.append(anchor + begin)
        hashes.append(h[anchor])
        last = places[-1][-1] if len(anchor) else last
    return np.concatenate(places), np.concatenate(hashes)


def _hashes(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of the contexts, both ends of which ascend."""
    out = np.empty(len(lo), np.uint64)
    cuts = np.searchsorted(lo, np.arange(0, len(data) + PIECE_BYTES, PIECE_BYTES)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a < b:
            out[a:b] = Hasher(data[lo[a] : hi[b - 1]]).ranges(lo[a:b] - lo[a], hi[a:b] - lo[a])
    return out


def _reports(table: pa.Table) -> pa.Table:
    """Each distinct (anchor, context) of a block at its first place, with its further places."""
    block = Block(table)
    at, h = anchors_of(block.data, block.offsets)
    lo, hi = block.contexts(at) if len(at) else (at, at)
    ctx = mix(_hashes(block.data, lo, hi) + (at - lo).astype(np.uint64)) if len(at) else h
    order = np.lexsort((at, ctx, h))
    at, h, ctx = at[order], h[order], ctx[order]
    fresh = np.r_[True, (h[1:] != h[:-1]) | (ctx[1:] != ctx[:-1])] if len(at) else np.empty(0, bool)
    first = np.flatnonzero(fresh)
    rest = at[~fresh]
    size = np.diff(np.r_[first, len(at)]) - 1
    more = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(rest))
    at = at[first]
    return pa.table(
        {
            "h": h[first].view(np.int64),
            "ctx": ctx[first].view(np.int64),
            "doc": block.order[block.row_of(at)] if len(at) else np.empty(0, np.int64),
            "block": np.full(len(at), block.number if len(at) else 0, np.int64),
            "at": at,
            "more": more,
        }
    )


# ---------------------------------------------------------------- who is a copy, who must be compared


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports sorted by anchor, context, place. Whole copies of an earlier context: h is null. First places of
    contexts whose anchor has others: with h."""
    waiting = None  # the first report of an anchor of which only one context has come yet
    last = None  # anchor and context of the last report
    names = ["h", "doc", "block", "at"]
    kinds = [pa.int64()] * 4
    for batch in batches:
        if not len(batch):
            continue
        h, ctx, doc, block, at = (batch.column(k).to_numpy() for k in range(5))
        new_h = np.r_[last is None or h[0] != last[0], h[1:] != h[:-1]]
        new = new_h | np.r_[last is None or ctx[0] != last[1], ctx[1:] != ctx[:-1]]
        first = np.flatnonzero(new)
        compare = ~new_h[first]  # another context of the anchor came before
        after = np.r_[compare[1:], False]  # another one comes next
        out = [np.empty((4, 0), np.int64)]
        if waiting is not None and len(first):
            if compare[0]:
                out.append(np.array(waiting, np.int64)[:, None])
            waiting = None
        if len(first) and not compare[-1]:
            i = first[-1]
            waiting = [h[i], doc[i], block[i], at[i]]
        some = first[compare | after]
        out.append(np.stack([h[some], doc[some], block[some], at[some]]))
        rows = np.concatenate(out, 1)
        copies = np.flatnonzero(~new)
        lists = batch.column(5)
        size = np.diff(lists.offsets.to_numpy())
        local_block = np.repeat(block, size)
        blocks, places = np.r_[block[copies], local_block], np.r_[at[copies], lists.flatten().to_numpy()]
        none = pa.nulls(len(blocks), pa.int64())
        columns = [pa.concat_arrays([pa.array(rows[0]), none]), pa.concat_arrays([pa.array(rows[1]), none])]
        columns += [pa.array(np.r_[rows[2], blocks]), pa.array(np.r_[rows[3], places])]
        last = (h[-1], ctx[-1])
        yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds, strict=True)], names)


# ---------------------------------------------------------------- comparing contexts


def _fetch(left: pa.Table, right: pa.Table) -> pa.Table:
    """The bytes of the contexts asked for, each with the number of bytes before its anchor."""
    empty = {"h": pa.int64(), "doc": pa.int64(), "block": pa.int64(), "at": pa.int64(), "before": pa.int64(), "bytes": pa.binary()}
    if not len(right) or not len(left):
        return pa.table({k: pa.array([], v) for k, v in empty.items()})
    block, at = Block(left), right.column("at").to_numpy()
    lo, hi = block.contexts(at)
    data = memoryview(block.data)
    data = pa.py_buffer(b"".join([data[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]))
    offsets = pa.py_buffer(np.r_[0, np.cumsum(hi - lo)].astype(np.int32).tobytes())
    return pa.table(
        [right.column("h"), right.column("doc"), right.column("block"), right.column("at"), pa.array(at - lo), pa.Array.from_buffers(pa.binary(), len(at), [None, offsets, data])],
        list(empty),
    )


def _ranks(sides: np.ndarray) -> np.ndarray:
    """Ranks of GRAM-byte symbols: by pairs of ranks of half the width, from 8 bytes on."""
    rows, width = sides.shape
    symbols = np.unique(np.ascontiguousarray(sides).view(">u8").astype(np.uint64), return_inverse=True)[1].reshape(rows, width // 8)
    for _ in range(2):
        pairs = symbols[:, ::2].astype(np.int64) * (symbols.max(initial=0) + 1) + symbols[:, 1::2]
        symbols = np.unique(pairs, return_inverse=True)[1].reshape(pairs.shape)
    return symbols


def _spread(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of bytes plus one, filled up with zeros; UTF-8 has no byte 255."""
    columns = np.arange(width)
    inside = columns[None, :] < sizes[:, None]
    index = np.where(inside, starts[:, None] + step * columns[None, :], 0)
    return np.where(inside, data[index] + np.uint8(1), np.uint8(0))


def _order(sides: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For the right and the left sides: their order, and the length that each shares with the one before it."""
    widths = [-(-s.shape[1] // GRAM) * GRAM for s in sides]
    ranks = _ranks(np.concatenate([np.pad(s, ((0, 0), (0, w - s.shape[1]))) for s, w in zip(sides, widths, strict=True)], 1)) + 2
    cut, n = widths[0] // GRAM, len(ranks)
    bar = np.ones((n, 1), ranks.dtype)
    text = np.concatenate([ranks[:, :cut], bar, ranks[:, cut:], bar], 1)
    length = text.shape[1]
    sa = np.array(suffix_array([*text.ravel().tolist(), 0]))
    out = []
    for side, first in zip(sides, (0, cut + 1), strict=True):
        order = sa[sa % length == first] // length
        order = order[order < n]
        differs = side[order[1:]] != side[order[:-1]]
        shared = np.where(differs.any(1), differs.argmax(1), side.shape[1])
        out.append((order, np.r_[0, shared]))
    return out


def compare(data: np.ndarray, starts: np.ndarray, before: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts in order of their places: pairs (context, r) such that the string from r bytes before the anchor
    also belongs to an earlier context."""
    anchor, after = starts + before, sizes - before
    right = _spread(data, anchor, after, LENGTH, 1)
    left = _spread(data, anchor - 1, before, BEFORE, -1)
    (order_r, shared_r), (order_l, shared_l) = _order([right, left])
    n, which, places = len(starts), [], []
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for r in range(BEFORE + 1):
        class_r[order_r] = np.cumsum(shared_r < LENGTH - r)
        class_l[order_l] = np.cumsum(shared_l < r)
        some = np.flatnonzero((before >= r) & (after >= LENGTH - r))
        some = some[np.bincount(class_r[some], minlength=n + 1)[class_r[some]] > 1]
        if not len(some):
            continue
        key = class_r[some] * (n + 1) + class_l[some]
        by = np.argsort(key, kind="stable")
        again = np.r_[False, key[by][1:] == key[by][:-1]]
        hit = some[by[again]]
        which.append(hit)
        places.append(np.full(len(hit), r))
    if not which:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(which), np.concatenate(places)


def _ranges(block: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Strings to remove, those of a block that overlap or touch as one range."""
    order = np.lexsort((start, block))
    block, start = block[order], start[order]
    fresh = np.r_[True, (block[1:] != block[:-1]) | (start[1:] > start[:-1] + LENGTH)] if len(start) else np.empty(0, bool)
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(start)] - 1
    return pa.RecordBatch.from_arrays([pa.array(block[first]), pa.array(start[first]), pa.array(start[last] + LENGTH)], ["block", "start", "stop"])


def _compare_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor and place; whole anchors are compared some thousand contexts at a time."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        column = table.column("bytes").chunk(0)
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2], np.uint8)
        order = np.lexsort([table.column(c).to_numpy() for c in ("at", "block", "doc")])
        which, r = compare(data, offsets[:-1][order], table.column("before").to_numpy()[order], np.diff(offsets)[order])
        return _ranges(table.column("block").to_numpy()[order][which], table.column("at").to_numpy()[order][which] - r)

    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if len(held) >= BATCH_CONTEXTS:
            h = held.column("h").to_numpy()
            cuts = np.flatnonzero(h[1:] != h[:-1]) + 1
            begin = 0
            while len(cuts) and cuts[-1] > begin and len(held) - begin >= BATCH_CONTEXTS:
                at = cuts[min(np.searchsorted(cuts, begin + BATCH_CONTEXTS), len(cuts) - 1)]
                yield settle(held.slice(begin, at - begin))
                begin = int(at)
            held = held.slice(begin)
    if held is not None and len(held):
        yield settle(held)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All strings of hot contexts with two hashes."""
    for batch in batches:
        doc, block, at, before = (batch.column(k).to_numpy() for k in range(1, 5))
        for part in slices(batch.column(5)):
            rows = np.arange(part.first, part.last)
            size = np.diff(part.offsets)
            count = np.maximum(size - LENGTH + 1, 0)
            row = np.repeat(rows, count)
            inside = np.arange(count.sum()) - np.repeat(np.r_[0, np.cumsum(count)[:-1]], count)
            start = part.offsets[row - part.first] + inside
            one = Hasher(part.data).ranges(start, start + LENGTH)
            two = Hasher(part.data, mix(BYTE_CODES)).ranges(start, start + LENGTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (one.view(np.int64), two.view(np.int64), doc[row], block[row], at[row] - before[row] + inside)],
                ["one", "two", "doc", "block", "start"],
            )


# ---------------------------------------------------------------- cutting


def _marks(block: Block, ranges: pa.Table) -> np.ndarray:
    """True for the bytes that go. A range without stop is the whole context of the anchor at start."""
    edge = np.zeros(len(block.data) + 1, np.int32)
    if len(ranges):
        start = ranges.column("start").to_numpy()
        stop = ranges.column("stop").fill_null(-1).to_numpy()
        whole = stop < 0
        lo, hi = block.contexts(start[whole]) if whole.any() else (start[:0], start[:0])
        np.add.at(edge, np.r_[start[~whole], lo], 1)
        np.add.at(edge, np.r_[stop[~whole], hi], -1)
    return np.cumsum(edge[:-1], dtype=np.int32, out=edge[:-1]) > 0


def _digest(left: pa.Table, right: pa.Table) -> pa.Table:
    block = Block(left)
    gone = _marks(block, right)
    lo, hi = block.offsets[:-1], block.offsets[1:]
    filled = hi > lo
    begins, ends = gone.copy(), gone.copy()  # first and last bytes of the runs, which never cross documents
    begins[1:] &= ~gone[:-1]
    ends[:-1] &= ~gone[1:]
    begins[lo[filled]], ends[hi[filled] - 1] = gone[lo[filled]], gone[hi[filled] - 1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    runs, total = np.searchsorted(begins, block.offsets), np.r_[0, np.cumsum(ends - begins)]
    kept = [hashlib.sha256(block.data[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(lo, hi, strict=True)]
    return pa.table(
        {
            "doc_id": pa.array(block.ids, pa.int64()),
            "n_bytes": hi - lo,
            "n_removed": np.diff(total[runs]),
            "n_spans": np.diff(runs),
            "kept_sha256": pa.array(kept, pa.string()),
        }
    )


def _texts(left: pa.Table, right: pa.Table) -> pa.Table:
    block = Block(left)
    gone = _marks(block, right)
    kept = [block.data[a:b][~gone[a:b]].tobytes() for a, b in zip(block.offsets[:-1], block.offsets[1:], strict=True)]
    return pa.table({"doc_id": pa.array(block.ids, pa.int64()), "text": pa.array(kept, pa.binary())})


def _bundles_and_ranges(docs: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    keyed = docs.select("doc_id", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 + size // BLOCK_BYTES)).alias("block"), "text")
    bundles = keyed.mapInArrow(_bundle, "block long, ids array<long>, sizes array<long>, z binary")

    reports = bundles.groupBy("block").applyInArrow(_reports, "h long, ctx long, doc long, block long, at long, more array<long>")
    sorted_ = reports.repartition("h").sortWithinPartitions("h", "ctx", "doc", "block", "at")
    judged = stored(sorted_.mapInArrow(_judge, "h long, doc long, block long, at long"), "judged")
    copies = judged.where("h is null").select("block", F.col("at").alias("start"), F.lit(None).cast("long").alias("stop"))

    asked = judged.where("h is not null")
    crowded = asked.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("h")
    fetched = "h long, doc long, block long, at long, before long, bytes binary"

    def fetch(some: DataFrame) -> DataFrame:
        return bundles.groupBy("block").cogroup(some.groupBy("block")).applyInArrow(_fetch, fetched)

    contexts = fetch(asked.join(crowded, "h", "left_anti"))
    ordered = contexts.repartition("h").sortWithinPartitions("h")
    ranges = copies.unionByName(ordered.mapInArrow(_compare_groups, "block long, start long, stop long"))
    if crowded.limit(1).count():
        strings = fetch(asked.join(crowded, "h", "left_semi")).mapInArrow(_strings, "one long, two long, doc long, block long, start long")
        strings = stored(strings, "strings")
        first = strings.groupBy("one", "two").agg(F.min(F.struct("doc", "block", "start")).alias("first"))
        later = strings.join(first, ["one", "two"]).where(F.struct("doc", "block", "start") > F.col("first"))
        ranges = ranges.unionByName(later.select("block", "start", (F.col("start") + LENGTH).alias("stop")))
    return bundles, ranges


def report(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    bundles, ranges = _bundles_and_ranges(docs, hot)
    both = bundles.groupBy("block").cogroup(ranges.groupBy("block"))
    return both.applyInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id and text (binary) without repeated strings."""
    bundles, ranges = _bundles_and_ranges(docs, hot)
    return bundles.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(_texts, "doc_id long, text binary")
