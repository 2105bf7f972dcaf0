"""Plain-Python versions of the operators, for small tables."""

import hashlib
import re
from itertools import combinations

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    words = SPACE.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def jaccard_components(rows, percent=80):
    """(id, text) rows -> sorted (id, size, component)."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations([r for r in sets if r[0] is not None], 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            u, v = find(a), find(b)
            parent[max(u, v)] = min(u, v)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def kept_words(rows, window=50):
    """(id, text) rows -> list of (id, words, kept words)."""
    words = [(i, SPACE.findall(t or "")) for i, t in rows]
    owner = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            g = tuple(w[p:p + window])
            if i is not None:
                owner[g] = min(owner.get(g, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and owner.get(tuple(w[p:p + window]), i) < i:
                gone.update(range(p, p + window))
        out.append((i, w, [x for p, x in enumerate(w) if p not in gone]))
    return out


def benchmark_hits(docs, items, n=10):
    """(id, words, hit places, item ids) of each document."""
    windows = []
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        k = min(n, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            windows.append((tuple(w[p:p + k]), item))
    out = []
    for i, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, named = set(), set()
        for g, item in windows:
            for p in range(len(w) - len(g) + 1):
                if tuple(w[p:p + len(g)]) == g:
                    hit.update(range(p, p + len(g)))
                    if item is not None:
                        named.add(str(item))
        out.append((i, w, hit, sorted(named)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
