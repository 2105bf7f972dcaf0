"""Signature trees: token bitmaps and sizes, joined by dual traversal.

A set of n tokens has a bitmap of 4n bits or more (a power of two); bit
``token mod width`` is set for each token. A wide bitmap folds onto a narrower
one by OR of its parts. For sets x and y on one width

    |x & y| <= |x| - (bits of x that y lacks)

as each such bit stands for a token of x that is not in y. A node holds the OR
of its members' bitmaps, the range of their sizes and their largest slack
(size minus own bits); for any members of two nodes

    |x & y| <= slack(X) + bits that both nodes have.
"""

from __future__ import annotations

import numpy as np

LEAF = 16


def bitmap(tokens: np.ndarray) -> bytes:
    """Bitmap of distinct 64-bit tokens."""
    width = max(64, 1 << (4 * max(1, len(tokens)) - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64-bit words folded to ``width`` words."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def popcount(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(axis=-1, dtype=np.int64)


def needed(na, nb, percent: int):
    """Least intersection of sizes na and nb at which 100 * intersection >=
    percent * union."""
    return -((-percent * (na + nb)) // (100 + percent))


def max_overlap(a: bytes, na: int, b: bytes, nb: int) -> int:
    """Upper bound of the intersection of two sets from their bitmaps."""
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    width = min(len(x), len(y))
    x, y = folded(x, width), folded(y, width)
    return int(min(na - popcount(x & ~y), nb - popcount(y & ~x)))


class Tree:
    """Members are ordered by label, then size, and grouped ``LEAF`` at a time
    level by level. A label is the member's component so far."""

    def __init__(self, bitmaps: list[bytes], sizes: np.ndarray, labels: np.ndarray):
        self.order = np.lexsort((sizes, labels))
        self.sizes, self.labels = sizes[self.order], labels[self.order]
        rows = [np.frombuffer(bitmaps[i], dtype=np.uint64) for i in self.order]
        self.width = min(len(r) for r in rows)
        self.bits = np.stack([folded(r, self.width) for r in rows])

    def levels(self, width: int) -> list[tuple[np.ndarray, ...]]:
        """By level from the members up: bitmaps of ``width`` words, least and
        largest size, slack, least and largest label."""
        bits = folded(self.bits, width)
        out = [(bits, self.sizes, self.sizes, self.sizes - popcount(bits), self.labels, self.labels)]
        while len(out[-1][1]) > 1:
            b, lo, hi, s, la, lb = out[-1]
            at = np.arange(0, len(lo), LEAF)
            out.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                        np.maximum.reduceat(s, at), np.minimum.reduceat(la, at), np.maximum.reduceat(lb, at)))
        return out


def dual(x: Tree, y: Tree, percent: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Members of x, members of y (as given to the trees) and the bound of
    their intersection, for pairs whose labels differ and whose sizes and
    bitmaps allow the similarity."""
    width = min(x.width, y.width)
    up, vp = x.levels(width), y.levels(width)
    out = []
    stack = [(len(up) - 1, len(vp) - 1, np.array([0]), np.array([0]))]
    while stack:
        i, j, p, q = stack.pop()
        bx, lox, hix, sx, lax, lbx = (a[p] for a in up[i])
        by, loy, hiy, sy, lay, lby = (a[q] for a in vp[j])
        same = (lax == lbx) & (lay == lby) & (lax == lay)
        both = popcount(bx & by)
        most = np.minimum(np.minimum(sx + both, sy + both), np.minimum(hix, hiy))
        least = needed(np.maximum(lox, -(-percent * loy // 100)), np.maximum(loy, -(-percent * lox // 100)), percent)
        apart = (100 * hix < percent * loy) | (100 * hiy < percent * lox)
        keep = ~same & ~apart & (most >= least)
        p, q = p[keep], q[keep]
        if i == 0 and j == 0:
            a, b, na, nb = up[0][0][p], vp[0][0][q], x.sizes[p], y.sizes[q]
            most = np.minimum(na - popcount(a & ~b), nb - popcount(b & ~a))
            fit = most >= needed(na, nb, percent)
            out.append((x.order[p[fit]], y.order[q[fit]], most[fit]))
            continue
        taller = up[i - 1][1] if i >= j else vp[j - 1][1]
        for s in range(0, len(p), 256):  # open the taller side's nodes
            a, b = p[s:s + 256], q[s:s + 256]
            own, other = (a, b) if i >= j else (b, a)
            kids = own[:, None] * LEAF + np.arange(LEAF)
            pick = kids < len(taller)
            kids, other = kids[pick], np.broadcast_to(other[:, None], pick.shape)[pick]
            stack.append((i - 1, j, kids, other) if i >= j else (i, j - 1, other, kids))
    return out


def candidates(left, right, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dual traversal of two member lists (bitmaps, sizes, labels): as
    ``dual``. Members are put into one tree for each bitmap width; sizes of the
    similarity differ by a factor of 100 / percent at most, so widths, rounded
    up to powers of two, by less than twice that."""
    trees = []
    for bitmaps, sizes, labels in (left, right):
        width = np.array([len(b) for b in bitmaps])
        own = {}
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            own[w] = at, Tree([bitmaps[i] for i in at], sizes[at], labels[at])
        trees.append(own)
    parts = [(np.empty(0, dtype=np.int64),) * 3]
    for w, (at, x) in trees[0].items():
        for v, (bt, y) in trees[1].items():
            if percent * max(v, w) < 200 * min(v, w):
                parts += [(at[i], bt[j], bound) for i, j, bound in dual(x, y, percent)]
    return tuple(np.concatenate(c) for c in zip(*parts))
