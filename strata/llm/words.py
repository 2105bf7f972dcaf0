"""Vectorised word tables of Arrow text batches.

Word classes of the operators are sets of ASCII bytes, and every byte of a
non-ASCII character is a word byte, so words can be found on UTF-8 bytes. All
work is done in numpy on bounded runs of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SEED = 20240607


def byte_class(separators: bytes) -> np.ndarray:
    """Boolean table by byte value: True for word bytes."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: words are runs of anything but ASCII white space
SPACE_WORDS = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
#: words are runs of ASCII letters, digits and non-ASCII characters
ALNUM_WORDS = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BYTE_VALUE = np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype=np.int64).astype(_U) | _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class _Powers(dict):
    """Tables that functions use. They are pickled with the functions, but
    empty: 16 MB for each of them otherwise, once the driver has used any."""

    def __reduce__(self):
        return _Powers, ()


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = _Powers()


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n or more."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(1 << 20, 1 << int(n).bit_length())
        up = np.full(size, _BASE, dtype=_U)
        down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=_U)
        up[0] = down[0] = 1
        if size > (1 << 23):  # rare long runs are not kept
            return np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)
        _powers[0] = (np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U))
    return _powers[0]


def _run_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2**64 of values[first:last] for each pair."""
    up, down = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * up[: len(values)], dtype=_U, out=sums[1:])
    return (sums[last] - sums[first]) * down[first]


class WordTable:
    """Words of consecutive texts.

    data      bytes of all texts, lower-cased (A-Z) if asked
    start     byte offset of each word; ``stop`` its exclusive end
    hashes    64-bit hash of each word
    bounds    words of text d are bounds[d]:bounds[d + 1]
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word: np.ndarray, lower: bool):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        inside = word[self.data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        begin[edges] = inside[edges]
        end = inside.copy()
        end[:-1] &= ~inside[1:]
        edges = offsets[1:][offsets[1:] > 0] - 1
        end[edges] = inside[edges]
        self.start = np.flatnonzero(begin)
        self.stop = np.flatnonzero(end) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        self.hashes = self._hash()

    def _hash(self, step: int = 1 << 20) -> np.ndarray:
        out = np.empty(len(self.start), dtype=_U)
        a = 0
        while a < len(out):  # whole words, about ``step`` bytes at a time
            b = max(a + 1, int(np.searchsorted(self.stop, self.start[a] + step)))
            lo = self.start[a]
            part = _BYTE_VALUE[self.data[lo:self.stop[b - 1]]]
            first, last = self.start[a:b] - lo, self.stop[a:b] - lo
            out[a:b] = mix(_run_hashes(part, first, last) ^ (last - first).astype(_U))
            a = b
        return out

    def prefixes(self, lengths: tuple[int, ...], step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each word's first k bytes, one row for each k, and which
        words are longer than that."""
        size = self.stop - self.start
        out = np.zeros((len(lengths), len(size)), dtype=_U)
        a = 0
        while a < len(size):
            b = max(a + 1, int(np.searchsorted(self.stop, self.start[a] + step)))
            lo = self.start[a]
            part = _BYTE_VALUE[self.data[lo:self.stop[b - 1]]]
            up, down = _power_tables(len(part) + 1)
            sums = np.zeros(len(part) + 1, dtype=_U)
            np.cumsum(part * up[: len(part)], dtype=_U, out=sums[1:])
            first = self.start[a:b] - lo
            for i, k in enumerate(lengths):
                last = np.minimum(first + k, len(part))
                out[i, a:b] = mix(((sums[last] - sums[first]) * down[first]) ^ _U(k << 32))
            a = b
        return out, size[None, :] > np.array(lengths)[:, None]

    def windows(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; k - 1 words fewer than words.
        Windows that cross texts are present too: see ``within``."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.empty(0, dtype=_U)
        out = np.empty(n, dtype=_U)
        step = 1 << 20
        for a in range(0, n, step):
            b = min(n, a + step)
            part = self.hashes[a:b + k - 1]
            first = np.arange(b - a)
            out[a:b] = mix(_run_hashes(part, first, first + k))
        return out

    def within(self, k: int) -> np.ndarray:
        """True for each window of ``windows(k)`` that lies in one text."""
        n = max(0, len(self.hashes) - k + 1)
        doc = self.doc()
        return doc[:n] == doc[k - 1:] if n else np.empty(0, dtype=bool)

    def doc(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def words(self, a: int, b: int) -> list[bytes]:
        """The words a:b as bytes."""
        return [self.data[s:e].tobytes() for s, e in zip(self.start[a:b], self.stop[a:b])]


def text_runs(texts: pa.Array | pa.ChunkedArray, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``limit`` bytes (a longer text comes alone), as
    (first row, end row, bytes, offsets). Null texts count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        b = min(b, n)
        yield a, b, raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def word_tables(texts, word: np.ndarray, lower: bool = False, limit: int = 2 << 20) -> Iterator[tuple[int, int, WordTable]]:
    """(first row, end row, WordTable) over an Arrow string column."""
    for a, b, data, offsets in text_runs(texts, limit):
        yield a, b, WordTable(data, offsets, word, lower)


def covered(starts: np.ndarray, lengths, n: int) -> np.ndarray:
    """Which of n places lie in one of the runs starts[i] : starts[i] + length."""
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, np.minimum(starts + lengths, n), -1)
    return np.cumsum(delta[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and exclusive ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
