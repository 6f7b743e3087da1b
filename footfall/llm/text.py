"""Work on whole text columns as byte arrays: bounded slices, words, hashes.

Arrow hands a text column over as one byte buffer with offsets, so words, hashes and windows of many
documents are computed with a few numpy passes. Slices are cut at document borders and hold about
SLICE_BYTES, or one document if that is longer; memory in a task is a small multiple of that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _byte_codes() -> np.ndarray:
    codes = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return codes


BYTE_CODES = _byte_codes()
#: A-Z hash like a-z.
LOWER_CODES = BYTE_CODES.copy()
LOWER_CODES[65:91] = BYTE_CODES[97:123]

#: Words of the decontamination contract: digits, letters, everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Words between blanks.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[9:14] = NOT_SPACE[32] = False


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Slice:
    """Documents `first` to `last` (exclusive) of a batch: their bytes and where each begins."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.last - self.first

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def starts_document(self) -> np.ndarray:
        """True at the first byte of each document, and one past the end."""
        at = np.zeros(len(self.data) + 1, bool)
        at[self.offsets] = True
        return at


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column; null counts as empty."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if binary else "")
    column = column.cast(pa.large_binary() if binary else pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), offsets


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Consecutive documents of about `limit` bytes together."""
    if not len(column):
        return
    data, offsets = buffers(column)
    first, n = 0, len(column)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        cut = offsets[first : last + 1]
        yield Slice(first, last, data[cut[0] : cut[-1]], cut - cut[0])
        first = last


class _Kept:
    """Arrays that a process keeps for itself: a pickled copy, as task functions carry it, is empty."""

    def __init__(self) -> None:
        self.arrays: list[np.ndarray] = []

    def __reduce__(self) -> tuple:
        return _Kept, ()


_powers = _Kept()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2^64."""
    if not _powers.arrays or len(_powers.arrays[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        made = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        if size > SLICE_BYTES * 4:  # of one very long text: not kept
            return made[0], made[1]
        _powers.arrays = made
    return _powers.arrays[0], _powers.arrays[1]


class Hasher:
    """Hashes of any byte ranges of a slice, from one prefix sum."""

    def __init__(self, data: np.ndarray, codes: np.ndarray = BYTE_CODES) -> None:
        self.up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * self.up[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of a slice: byte ranges, hashes, and per document where its words begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def find_words(part: Slice, members: np.ndarray, codes: np.ndarray = LOWER_CODES) -> Words:
    """Runs of bytes of the class `members`, never across documents."""
    inside = np.zeros(len(part.data) + 2, bool)
    inside[1:-1] = members[part.data]
    fresh = part.starts_document()
    now, before = inside[1:], inside[:-1]
    starts = np.flatnonzero(now & (~before | fresh))
    ends = np.flatnonzero(before & (~now | fresh))
    hashes = Hasher(part.data, codes).ranges(starts, ends) if len(starts) else np.empty(0, np.uint64)
    return Words(starts, ends, hashes, np.searchsorted(starts, part.offsets))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; shorter by n-1. May cross documents."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:m].copy()
    for k in range(1, n):
        total *= np.uint64(_BASE)
        total += hashes[k : k + m]
    return mix(total + np.uint64(n))
