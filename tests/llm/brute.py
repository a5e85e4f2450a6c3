"""Plain versions of what the operators give, for small tables."""

from __future__ import annotations

import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text: str | None, k: int = 5) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def jaccard(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def components(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, smallest doc_id of its component) over distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            s, t = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def fold(doc_id: int, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n
