"""Pre-tokens of byte-level BPE and their numbers of pieces, on Arrow and numpy
buffers.

Texts of Latin letters and general punctuation are split on their UTF-8 bytes:
the expression of ``splitter`` is spelled as edges between runs of letters,
numbers, blanks and other characters. All other texts, and those with special
strings, are split by the tokenizer. Pieces are counted for many pre-tokens at
once: in each round every pre-token joins its leftmost pair of lowest rank, as
the library does.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

from strata.llm.splitter import _BLANK, _LETTER, _NUMBER, Splitter

#: longer pre-tokens, in bytes, are encoded by the library
LONG = 64
#: bytes of the pre-tokens that are counted at once (a longer one comes alone):
#: encodings and tables of merges take up to 80 times as much
AT_ONCE = 512 << 10
_OTHER, _L, _N, _B, _BAD = range(5)


def _classes() -> np.ndarray:
    """Character classes of U+0000 to U+024F, then of U+2000 to U+205F."""
    out = np.full(0x250 + 0x60, _OTHER, dtype=np.uint8)
    for c, chars in ((_L, _LETTER), (_N, _NUMBER), (_B, _BLANK)):
        out[[i for i in range(0x250) if re.match(f"[{chars}]", chr(i))]] = c
    out[0x250:0x260] = out[0x278:0x280] = out[0x2AF] = _BAD  # U+2000.., U+2028.., U+205F
    return out


_CLASS = _classes()
_ENDINGS = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]


def _edges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pre-tokens begin in ``data``, and which of the texts are not of
    the characters that this can split."""
    kind = _CLASS[data]
    wide = np.flatnonzero(data >= 0xC0)
    begin = data & 0xC0
    begin = begin != 0x80
    odd = np.zeros(len(offsets) - 1, dtype=bool)
    if len(wide):
        lead, second = data[wide].astype(np.int64), data[wide + 1].astype(np.int64) & 0x3F
        third = data[np.minimum(wide + 2, len(data) - 1)].astype(np.int64) & 0x3F
        two, three = lead < 0xE0, (lead == 0xE2) & (second < 2)
        point = np.where(two, ((lead & 0x1F) << 6) | second, np.where(three, 0x250 + ((second << 6) | third), 0x250))
        point[two & (point >= 0x250) | three & (point >= len(_CLASS))] = 0x250
        of = _CLASS[point]
        kind[wide] = kind[wide + 1] = of
        kind[wide[three] + 2] = of[three]
        odd[np.searchsorted(offsets, wide[of == _BAD], side="right") - 1] = True
    first = np.zeros(len(data), dtype=bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    out = run.copy()
    # the last blank before a run is apart; a space joins the run
    after = np.flatnonzero(run & ~first & (kind != _B))
    after = after[kind[after - 1] == _B]
    out[after - 1 - ~begin[after - 1]] = True
    spaced = after[data[after - 1] == 0x20]
    out[spaced] = False
    # 's, 't, 're ... after anything but a space
    quote = np.flatnonzero((data == 0x27) & out)
    quote = quote[quote + 1 < len(data)]
    quote = quote[(kind[quote + 1] == _L) & ~first[quote + 1]]
    a, b = data[quote + 1], data[np.minimum(quote + 2, len(data) - 1)]
    inside = (quote + 2 < len(data)) & ~first[np.minimum(quote + 2, len(data) - 1)]
    size = np.zeros(len(quote), dtype=np.int64)
    for x in _ENDINGS:
        size[(a == x[0]) if len(x) == 1 else (a == x[0]) & inside & (b == x[1])] = len(x)
    quote, size = quote[size > 0], size[size > 0]
    out[quote + 1] = False
    rest = quote + 1 + size
    out[rest[rest < len(data)]] = True
    return out, odd


def pretokens(data: np.ndarray, offsets: np.ndarray, own: Splitter) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Pre-tokens of texts (their bytes and offsets) as one array, which of
    them are of text d (bounds[d]:bounds[d + 1]), and each text's number of
    special strings."""
    n = len(offsets) - 1
    extra = np.zeros(n, dtype=np.int64)
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(n + 1, dtype=np.int64), extra
    out, odd = _edges(data, offsets)
    body = data.tobytes()
    if own.special is not None:
        special, at = re.compile(own.special.pattern.encode()), 0
        while m := special.search(body, at):
            d = np.searchsorted(offsets, m.start(), side="right") - 1
            odd[d], at = True, int(offsets[d + 1])
    start = np.flatnonzero(out)
    bounds = np.searchsorted(start, offsets)
    plain = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(start, len(data)).astype(np.int64)), pa.py_buffer(body))
    if not odd.any():
        return plain, bounds, extra
    parts, size, a = [], np.diff(bounds), 0
    for d in np.flatnonzero(odd).tolist():
        tokens, extra[d] = own.parts(body[offsets[d]:offsets[d + 1]].decode())
        parts += [plain.slice(bounds[a], bounds[d] - bounds[a]), pa.array(tokens, pa.large_string())]
        size[d], a = len(tokens), d + 1
    parts.append(plain.slice(bounds[a]))
    return pa.concat_arrays(parts), np.concatenate(([0], np.cumsum(size))), extra


def _parts(size: np.ndarray, most: int):
    """Ranges of at most ``most`` strings of at most ``AT_ONCE`` bytes together."""
    end, a = np.cumsum(size), 0
    while a < len(size):
        fit = int(np.searchsorted(end, end[a] - size[a] + AT_ONCE, side="right"))
        b = min(a + most, max(a + 1, fit))
        yield a, b
        a = b


class Merges:
    """A tokenizer's merges by pair of piece numbers. ``usable`` is false if
    the model has more than merges; then the library counts all."""

    def __init__(self, body: str):
        model = json.loads(body)["model"]
        vocab = model["vocab"]
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        char = {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        self.usable = (model.get("type", "BPE") == "BPE" and all(c in vocab for c in char.values()) and len(vocab) < 1 << 20
                       and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                          "fuse_unk", "byte_fallback", "ignore_merges")))
        if not self.usable:
            return
        self.byte = np.array([vocab[char[b]] for b in range(256)], dtype=np.int32)
        ranks = {}
        for i, x in enumerate(model["merges"]):
            a, b = x.split(" ") if isinstance(x, str) else x
            ranks[vocab[a] << 20 | vocab[b]] = (i, vocab[a + b])
        keys = np.array(list(ranks), dtype=np.int64)
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        slot, keys = slot[order], keys[order]
        self.none = len(model["merges"])  # above all ranks
        self.keys = np.append(keys, -1)
        self.ranks = np.append(np.array([ranks[k][0] for k in keys.tolist()], dtype=np.int64), self.none)
        self.made = np.zeros(self.none + 1, dtype=np.int32)
        for i, made in ranks.values():
            self.made[i] = made
        self.first = np.searchsorted(slot, np.arange((1 << 19) + 1)).astype(np.int32)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(45)).view(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of pieces: their keys lie in order of slots."""
        keys = left.astype(np.int64) << 20 | right
        out = np.full(len(keys), self.none, dtype=np.int64)
        slot = self._slot(keys)
        at, end = self.first[slot], self.first[slot + 1]
        todo = np.flatnonzero(at < end)
        at = at[todo]
        while len(todo):
            same = self.keys[at] == keys[todo]
            out[todo[same]] = self.ranks[at[same]]
            more = ~same & (at + 1 < end[todo])
            todo, at = todo[more], at[more] + 1
        return out

    def _merged(self, data: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of pieces of strings of ``size`` bytes, 1 to ``LONG``."""
        count, owner, none = size.copy(), np.arange(len(size)), self.none << 6
        start = np.cumsum(size) - size
        place = np.arange(len(data)) - np.repeat(start, size)
        piece = self.byte[data]
        ahead, back = (place + 1).astype(np.int8), (place - 1).astype(np.int8)  # places of the neighbours
        key = np.full(len(piece), none, dtype=np.int64)  # rank and place of a piece and the next one
        pair = np.ones(len(piece), dtype=bool)
        pair[start + size - 1] = False
        pair = np.flatnonzero(pair)
        key[pair] = self._rank(piece[pair], piece[pair + 1]) << 6 | place[pair]
        while len(owner):
            low = np.minimum.reduceat(key, start)
            live = np.flatnonzero(low < none)
            if len(live) < 0.8 * len(owner):  # others are done
                keep = np.zeros(len(owner), dtype=bool)
                keep[live] = True
                inside = np.repeat(keep, size)
                piece, key, ahead, back = piece[inside], key[inside], ahead[inside], back[inside]
                size, owner, low = size[live], owner[live], low[live]
                start = np.cumsum(size) - size
                live = np.arange(len(owner))
            if not len(live):
                break
            at, low = start[live], low[live]
            end, p = size[live], low & 63
            new = self.made[low >> 6]
            i = at + p
            gone = at + ahead[i]
            q = ahead[gone]
            piece[i], ahead[i], key[i], key[gone] = new, q, none, none
            count[owner[live]] -= 1
            r = np.flatnonzero(q < end)
            right = at[r] + q[r]
            back[right] = p[r]
            b = back[i]
            x = np.flatnonzero(b >= 0)
            left = at[x] + b[x]
            rank = self._rank(np.concatenate((new[r], piece[left])), np.concatenate((piece[right], new[x])))
            rank = np.where(rank < self.none, rank << 6, none)
            key[i[r]], key[left] = rank[:len(r)] | p[r], rank[len(r):] | b[x]
        return count

    def pieces(self, tokens: pa.LargeStringArray, own: Splitter, most: int) -> np.ndarray:
        """Numbers of pieces of pre-tokens, at most ``most`` at once."""
        _, off, data = tokens.buffers()
        off = np.frombuffer(off, dtype=np.int64)[tokens.offset:tokens.offset + len(tokens) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
        size = np.diff(off)
        out = np.zeros(len(size), dtype=np.int64)
        long = np.flatnonzero(size > LONG) if self.usable else np.arange(len(size))
        for a, b in _parts(size[long], most):
            some = long[a:b]
            out[some] = [len(e) for e in own.encoded(tokens.take(pa.array(some)).to_pylist())]
        if self.usable:
            fits = size <= LONG
            for a, b in _parts(size, most):
                some = fits[a:b]
                if some.any():
                    part = data[off[a]:off[b]][np.repeat(some, size[a:b])]
                    out[a:b][some] = self._merged(part, size[a:b][some])
        return out
