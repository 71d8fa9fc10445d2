"""Plain-Python restatements of the operators' contracts (no Spark, no numpy)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

UP, LO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = str.maketrans(UP, LO)


def lower(text: str) -> str:
    return text.translate(_LOWER)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def item_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def base_rules(text: str | None) -> tuple:
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            hit |= set(range(i, i + 8))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit),
            len(w) < 20 or 100 * len(hit) > 30 * len(w))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text: str | None, size: int) -> set[tuple]:
    w = words(lower(text or ""))
    if not w:
        return set()
    size = min(size, len(w))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def jaccard_components(texts: dict, size: int, num: int, den: int) -> dict:
    """id -> (set size, least id reachable) by comparing all pairs."""
    sets = {k: shingles(t, size) for k, t in texts.items()}
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if den * small < num * large:
                continue
            inter = len(sets[a] & sets[b])
            if den * inter >= num * (len(sets[a]) + len(sets[b]) - inter):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


def contamination(text: str | None, items: dict, window: int = 10) -> tuple:
    """(words, hit words, ids of the items with windows in the text)."""
    w = item_words(text)
    places: dict[str, list[int]] = {}
    for i, x in enumerate(w):
        places.setdefault(x, []).append(i)
    hit, found = set(), set()
    for item_id, item in items.items():
        v = item_words(item)
        size = min(window, len(v))
        for o in range(len(v) - size + 1) if v else ():
            for i in places.get(v[o], ()):
                if w[i:i + size] == v[o:o + size]:
                    hit |= set(range(i, i + size))
                    found.add(item_id)
    return len(w), len(hit), found
