"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def repeated_bytes(rows: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple]:
    """doc_id: n_bytes, n_removed, n_spans, kept_sha256."""
    seen, out = set(), {}
    for doc, text in sorted((d, (t or "").encode()) for d, t in rows):
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            piece = text[p : p + length]
            if piece in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(piece)
        spans = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        out[doc] = (len(text), sum(gone), spans, sha(bytes(x for x, g in zip(text, gone, strict=True) if not g)))
    return out


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def strong_secrets(text: str | None) -> list[tuple[int, int, str]]:
    text, out = text or "", []
    out += [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def alnum_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs: list[tuple[int, str | None]], items: list[tuple[object, str | None]], window: int = 10) -> dict[int, tuple]:
    """doc_id: n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = defaultdict(set)
    for name, text in items:
        words = alnum_words(text)
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])].add("" if name is None else str(name))
    sizes, out = {len(w) for w in windows}, {}
    for doc, text in docs:
        words, hit, names = alnum_words(text), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                found = windows.get(tuple(words[k : k + n]))
                if found:
                    hit.update(range(k, k + n))
                    names |= found
        out[doc] = (len(words), len(hit), len(names), sha(",".join(sorted(names))), bool(hit))
    return out


def shingle_set(text: str | None, n: int = 5) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1)))


def near_groups(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    """doc_id: n_shingles, component_id, kept."""
    sets = {d: shingle_set(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sorted(sets.items()):
        common = Counter(o for x in s for o in holders[x])
        for o, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[o]) - n):
                a, b = sorted((find(d), find(o)))
                parent[b] = a
        for x in s:
            holders[x].append(d)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}
