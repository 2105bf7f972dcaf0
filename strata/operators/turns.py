"""The listings of one group taken in turn, inside a Python worker.

``take_turns`` gets a group's listings and the offers on their keys and walks
over the listings in order. Offers lie in a tree over the listings' prices
(as in ``price_index``): a band covers at most two nodes a level, a price asks
one node a level. Each node has its clients in the order in which they are
taken, latest viewing first; clients that have left are passed over once and
then skipped by a pointer. So a turn costs some ``k`` look-ups a level, however
many offers hold the listing's price and however many clients have left.

The module is pickled by value, so executors need not have the package.
"""

from __future__ import annotations

import sys
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _numbers(column) -> np.ndarray:
    return pc.fill_null(column, 0).combine_chunks().to_numpy(zero_copy_only=False)


def _ranked(column) -> tuple[np.ndarray, pa.Array]:
    """Ranks of texts (-1 for null), and the distinct texts in order."""
    coded = pa.concat_arrays(column.chunks).dictionary_encode() if column.num_chunks else pa.array([], column.type).dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order) + 1, np.int64)
    rank[order], rank[-1] = np.arange(len(order)), -1
    return rank[pc.fill_null(coded.indices, len(order)).to_numpy(zero_copy_only=False)], coded.dictionary.take(pa.array(order))


class Offers:
    """Offers of a group by price tree and by client.

    ``key`` and ``price``: of the listings' rows. ``leaf``: each row's price
    in the tree."""

    def __init__(self, key: np.ndarray, price: np.ndarray, offers: pa.Table):
        order = np.lexsort((price, key))
        k, p = key[order], price[order]
        fresh = np.ones(len(k), bool)
        fresh[1:] = (k[1:] != k[:-1]) | (p[1:] != p[:-1])
        self.leaf = np.empty(len(k), np.int64)
        self.leaf[order] = np.cumsum(fresh) - 1
        leaf_key, leaf_price = k[fresh], p[fresh]
        self.size = 1 << max(len(leaf_key) - 1, 1).bit_length()

        client, self.cids = _ranked(offers["cid"])
        self.clients = max(len(self.cids), 1)
        seen, times = _ranked(offers["ms"])
        turn = np.where(seen < 0, len(times), len(times) - 1 - seen) * self.clients + client
        low, high = self._covered(leaf_key, leaf_price, _numbers(offers["key"]), _numbers(offers["price_start"]), _numbers(offers["price_end"]))
        self._tree(low, high, turn)
        # rows of a pair, by key and client
        keys = np.unique(leaf_key)
        self.key_of = np.searchsorted(keys, leaf_key) * self.clients
        pair = np.searchsorted(keys, _numbers(offers["key"])) * self.clients + client
        by = np.argsort(pair, kind="stable")
        self.pair, self.low, self.high, self.n = (memoryview(np.ascontiguousarray(x[by])) for x in (pair, low, high, _numbers(offers["n"])))
        self.key_of = memoryview(self.key_of)
        self.allowed = np.zeros(self.clients, np.int64)
        self.allowed[client] = _numbers(offers["allowed"])
        self.allowed = self.allowed.tolist()
        self.gone = bytearray(self.clients)

    @staticmethod
    def _covered(leaf_key, leaf_price, key, start, end) -> tuple[np.ndarray, np.ndarray]:
        """First and last leaf whose price lies in each offer's band."""
        low, high = np.zeros(len(key), np.int64), np.full(len(key), -1, np.int64)
        order = np.argsort(key, kind="stable")
        keys, at = np.unique(key[order], return_index=True)
        first, last = np.searchsorted(leaf_key, keys, "left"), np.searchsorted(leaf_key, keys, "right")
        for a, b, f, t in zip(at, [*at[1:], len(key)], first, last):
            rows, prices = order[a:b], leaf_price[f:t]
            low[rows] = f + np.searchsorted(prices, start[rows], "left")
            high[rows] = f + np.searchsorted(prices, end[rows], "right") - 1
        return low, high

    def _tree(self, low, high, turn) -> None:
        nodes, turns = [], []
        l, r = low + self.size, high + 1 + self.size
        while True:
            on = l < r
            if not on.any():
                break
            l, r, turn = l[on], r[on], turn[on]
            for odd, node in (((l & 1) == 1, l), ((r & 1) == 1, r - 1)):
                nodes.append(node[odd])
                turns.append(turn[odd])
            l, r = (l + 1) >> 1, r >> 1
        node, turn = np.concatenate([[], *nodes]).astype(np.int64), np.concatenate([[], *turns]).astype(np.int64)
        order = np.lexsort((turn, node))
        node, turn = node[order], turn[order]
        # a client counts once in a node, with its latest viewing
        keep = np.sort(np.unique(node * self.clients + turn % self.clients, return_index=True)[1])
        node, turn = node[keep], turn[keep]
        heads, first = np.unique(node, return_index=True)
        ends = np.append(first[1:], len(node))[:len(first)]
        self.turn = memoryview(np.ascontiguousarray(np.insert(turn, ends, -1)))  # -1 ends a node's list
        self.next = memoryview(np.arange(1, len(self.turn) + 1, dtype=np.int64))
        head = np.full(2 * self.size, -1, np.int64)
        head[heads] = first + np.arange(len(first))
        self.head = memoryview(head)

    def first(self, leaf: int, m: int) -> list[int]:
        """The turns of the first ``m`` clients in the pool at a leaf."""
        found, node = [], leaf + self.size
        head, turn, following, clients, gone = self.head, self.turn, self.next, self.clients, self.gone
        while node:
            i, got, before = head[node], 0, -1
            while i >= 0 and (t := turn[i]) >= 0:
                if gone[t % clients]:
                    i = following[i]
                    if before < 0:
                        head[node] = i
                    else:
                        following[before] = i
                    continue
                found.append(t)
                got += 1
                if got == m:
                    break
                before, i = i, following[i]
            node >>= 1
        found.sort()
        out, known = [], set()
        for t in found:
            if t % clients not in known:
                known.add(t % clients)
                out.append(t)
                if len(out) == m:
                    break
        return out

    def rows(self, leaf: int, client: int) -> int:
        """Intent rows of a client that match at a leaf."""
        pair = self.key_of[leaf] + client
        i, total = bisect_left(self.pair, pair), 0
        while i < len(self.pair) and self.pair[i] == pair:
            if self.low[i] <= leaf <= self.high[i]:
                total += self.n[i]
            i += 1
        return total


def take_turns(listings: pa.Table, offers: pa.Table, told: pa.Table, k: int, min_clients: int) -> dict[str, list]:
    """What each listing takes: ``listing``, ``tier``, ``cid``, ``n`` rows.

    ``listings``: ``listing``, ``tier``, ``key``, ``price``. ``offers``: ``key``,
    ``price_start``, ``price_end``, ``cid``, ``ms``, ``n``, ``allowed``.
    ``told``: what listings of other groups take (``listing``, ``cid``, ``n``)."""
    out = {"listing": [], "tier": [], "cid": [], "n": []}
    if not (listings.num_rows and offers.num_rows):
        return out
    pool = Offers(_numbers(listings["key"]), _numbers(listings["price"]), offers)
    number, tier = _numbers(listings["listing"]), _numbers(listings["tier"])
    names, at = np.unique(number, return_inverse=True)
    leaves = np.full((len(names), 2), -1, np.int64)
    leaves[at, tier - 1] = pool.leaf
    events = sorted((x, c, n) for x, c, n in zip(
        _numbers(told["listing"]).tolist(), pc.index_in(told["cid"], pool.cids).to_pylist(), _numbers(told["n"]).tolist()) if c is not None)
    used, allowed, gone, clients, heard = [0] * pool.clients, pool.allowed, pool.gone, pool.clients, 0
    picked = []
    for listing, (place, area) in zip(names.tolist(), leaves.tolist()):
        while heard < len(events) and events[heard][0] < listing:
            _, c, n = events[heard]
            heard += 1
            used[c] += n
            if used[c] > allowed[c]:
                gone[c] = 1
        own = pool.first(place, max(k, min_clients)) if place >= 0 else []
        turns = [(t, 1) for t in own]
        if len(own) < min_clients and area >= 0:
            there = {t % clients for t in own}
            turns += [(t, 2) for t in pool.first(area, k + len(own)) if t % clients not in there]
            turns.sort()
        for t, tier_of in turns[:k]:
            c = t % clients
            n = pool.rows(place if tier_of == 1 else area, c)
            picked.append((listing, tier_of, c, n))
            used[c] += n
            if used[c] > allowed[c]:
                gone[c] = 1
    if picked:
        out["listing"], out["tier"], c, out["n"] = (list(x) for x in zip(*picked))
        out["cid"] = pool.cids.take(pa.array(c))
    return out
