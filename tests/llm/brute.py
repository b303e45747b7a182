"""Brute-force versions the operators are held against."""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, k: int) -> set[tuple[str, ...]]:
    w = words(lower(text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def components(ids, links) -> dict:
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    return {i: find(i) for i in ids}


def near_duplicates(docs, k, percent):
    sets = {i: shingles(t, k) for i, t in docs}
    links = [
        (a, b)
        for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    component = components(sets, links)
    return {(i, len(sets[i]), component[i], component[i] == i) for i in sets}


def repeated_windows(docs, size):
    """doc_id -> (words, removed, sha256 of the kept words)."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        w = words(t)
        gone = set()
        for s in range(len(w) - size + 1):
            window = tuple(w[s : s + size])
            if window in seen:
                gone.update(range(s, s + size))
            seen.add(window)
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest())
    return out


def repeated_bytes(docs, size):
    """doc_id -> (bytes, removed, spans, sha256 of the rest)."""
    count, out = {}, {}
    raw = {i: (t or "").encode() for i, t in docs}
    for b in raw.values():
        for s in range(len(b) - size + 1):
            count[b[s : s + size]] = count.get(b[s : s + size], 0) + 1
    for i, b in raw.items():
        gone = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if count[b[s : s + size]] > 1:
                gone[s : s + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def discounts(values):
    n = [sum(1 for v in values if v == i) for i in (1, 2, 3, 4)]
    if not min(n):
        return (0.5, 1.0, 1.5)
    y = n[0] / (n[0] + 2 * n[1])
    found = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
    return tuple(d if 0 < d < i else f for i, d, f in zip((1, 2, 3), found, (0.5, 1.0, 1.5), strict=True))


def kneser_ney(train, docs):
    """doc_id -> (tokens, known, base score, score), from dictionaries."""
    from collections import Counter, defaultdict
    from math import log10

    toks = lambda t: [*words(lower(t or "")), None]
    uni, bi = Counter(), Counter()
    for _, t in train:
        w = toks(t)
        uni.update(w)
        bi.update(zip([0, *w[:-1]], w, strict=True))
    left, after, kinds = Counter(), Counter(), defaultdict(Counter)
    for (v, w), c in bi.items():
        left[w] += 1
        after[v] += c
        kinds[v][min(c, 3)] += 1
    d, dl = discounts(bi.values()), discounts(left.values())
    total, n, size = sum(left.values()), sum(uni.values()), len(uni)
    spare = sum(dl[min(c, 3) - 1] for c in left.values()) / total if total else 1.0

    def low(w):
        c = left[w]
        return (max(c - dl[min(c, 3) - 1], 0) / total if c else 0) + spare / (size + 1)

    def prob(v, w):
        if not after[v]:
            return low(w)
        c = bi[v, w]
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / after[v] + sum(d[i - 1] * kinds[v][i] for i in (1, 2, 3)) / after[v] * low(w)

    out = {}
    for i, t in docs:
        w = toks(t)
        base = sum(log10((uni[x] + 0.1) / (n + 0.1 * (size + 1))) for x in w)
        out[i] = (len(w), sum(x in uni for x in w), base, sum(log10(prob(v, x)) for v, x in zip([0, *w[:-1]], w, strict=True)))
    return out
