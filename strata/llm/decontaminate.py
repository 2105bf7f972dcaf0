"""Benchmark decontamination: hash set of normalised test n-grams.

Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z
lower-cased. Every run of ``n`` consecutive words of a benchmark item is a
window; an item of fewer words, but not none, is one window.

The windows are broadcast in blocks of at most ``block_windows`` windows (a
proven bound); a larger benchmark is scanned block after block within the same
stage, each pass adding to the hits of the one before. A document's windows
are looked up by 64-bit hash and each hit is verified on the words themselves.
No shuffle, one pass over the texts for each block.

Defined cases: a null or empty text has no words and no hits; null items and
items without words have no windows; items repeated under one id count once;
an item's id that is null is reported as no item though its words are hit;
an empty benchmark hits nothing; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import Step, field, map_steps, others, read
from strata.llm.words import ALNUM_WORDS, WordTable, covered, runs, word_tables

WINDOW = 10
BLOCK_WINDOWS = 200_000

Windows = dict[int, dict[tuple[bytes, ...], set[str]]]


def item_windows(text: str | None, n: int) -> list[tuple[int, tuple[bytes, ...]]]:
    """(hash, words) of each window of one benchmark item."""
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    table = WordTable(data, np.array([0, len(data)]), ALNUM_WORDS, lower=True)
    total = len(table.hashes)
    if total == 0:
        return []
    k = min(n, total)
    words = table.words(0, total)
    return [(int(h), tuple(words[i:i + k])) for i, h in enumerate(table.windows(k))]


def window_blocks(benchmark: DataFrame, item_id: str, text: str, n: int, limit: int) -> Iterator[dict[int, Windows]]:
    """Windows by length and hash, at most about ``limit`` at a time; the
    driver holds one block and one partition of the benchmark."""
    block: dict[int, Windows] = {}
    count = 0
    for item, body in benchmark.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        for h, words in item_windows(body, n):
            named = block.setdefault(len(words), {}).setdefault(h, {}).setdefault(words, set())
            if item is not None:
                named.add(item)
            count += 1
        if count >= limit:
            yield block
            block, count = {}, 0
    if block:
        yield block


class _Lookup:
    """Windows of one length: a bit table first, then the exact words."""

    def __init__(self, windows: Windows, bits: int = 20):
        self.windows = windows
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.sorted = np.sort(np.fromiter(windows, dtype=np.uint64, count=len(windows)))
        self.table[self.sorted >> self.shift] = True

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.table[hashes >> self.shift])
        found = np.searchsorted(self.sorted, hashes[at])
        found[found == len(self.sorted)] = 0
        return at[self.sorted[found] == hashes[at]]


def find_hits(table: WordTable, lookups: dict[int, _Lookup]) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Verified windows: first word, number of words, items."""
    starts, lengths, items = [], [], []
    for k, lookup in lookups.items():
        hashes = table.windows(k)
        at = lookup.candidates(hashes)
        at = at[table.within(k)[at]] if len(at) else at
        for p, h in zip(at.tolist(), hashes[at].tolist()):
            named = lookup.windows[h].get(tuple(table.words(p, p + k)))
            if named is not None:
                starts.append(p)
                lengths.append(k)
                items.append(named)
    order = np.argsort(starts, kind="stable")
    return np.array(starts, dtype=np.int64)[order], np.array(lengths, dtype=np.int64)[order], [items[i] for i in order]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, *, with_text: bool = True, **options) -> DataFrame:
    """One row per row of ``docs``: its id, text (if asked), word count,
    covered word ranges ``first``/``end``, the ids of the items found, and if
    asked its other columns as the struct ``rest``."""
    out = map_steps(*_hit_steps(docs, benchmark, with_text=with_text, **options))
    return out if with_text else out.drop("text")


def _hit_steps(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", n: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
               with_text: bool = True, with_rest: bool = False) -> tuple[DataFrame, list[tuple[str, Step]]]:
    """What ``benchmark_hits`` reads of ``docs``, and a step for each block of windows."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"id {kind}, text string, n_words bigint, first array<int>, `end` array<int>, items array<string>"
    rest = others(docs, doc_id, text) if with_rest else None
    out = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *([rest] if rest is not None else []))
    if rest is not None:
        schema += f", {field(out, 'rest')}"
    blocks = window_blocks(benchmark, item_id, item_text, n, block_windows)
    sent = [spark.sparkContext.broadcast(b) for b in blocks] or [spark.sparkContext.broadcast({})]
    return out, [(schema, _scan(block, keep=with_text or i + 1 < len(sent))) for i, block in enumerate(sent)]


def _scan(block, keep: bool):
    cache: dict[str, dict[int, _Lookup]] = {}

    def scan(batch: pa.RecordBatch):
        if "it" not in cache:
            cache["it"] = {k: _Lookup(w) for k, w in block.value.items()}
        names = batch.schema.names
        before = "items" in names
        for a, b, table in word_tables(batch.column(names.index("text")), ALNUM_WORDS, lower=True):
            part = batch.slice(a, b - a)
            starts, lengths, items = find_hits(table, cache["it"])
            first, end, found = [], [], []
            cut = np.searchsorted(starts, table.bounds)
            old = [part.column(names.index(c)).to_pylist() for c in ("first", "end", "items")] if before else None
            for d in range(b - a):
                lo, hi = cut[d], cut[d + 1]
                base, total = table.bounds[d], table.bounds[d + 1] - table.bounds[d]
                s, w = starts[lo:hi] - base, lengths[lo:hi]
                named = set().union(*items[lo:hi]) if hi > lo else set()
                if before:
                    s = np.concatenate((s, np.array(old[0][d], dtype=np.int64)))
                    w = np.concatenate((w, np.array(old[1][d], dtype=np.int64) - np.array(old[0][d], dtype=np.int64)))
                    named |= set(old[2][d])
                f, e = runs(covered(s, w, int(total))) if len(s) else ((), ())
                first.append(list(f))
                end.append(list(e))
                found.append(sorted(named))
            body = part.column(names.index("text"))
            yield {"id": part.column(names.index("id")), "text": body if keep else pa.nulls(b - a, pa.string()),
                   "n_words": np.diff(table.bounds), "first": first, "end": end, "items": found,
                   **({"rest": part.column(names.index("rest"))} if "rest" in names else {})}

    return scan


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "remove_spans", *, doc_id: str = "doc_id",
                  text: str = "text", **options) -> DataFrame:
    """``docs`` (id, text, n_hit and, if asked, rest) after the hits are dealt with: ``remove_spans``
    cuts each covered run of words out of the text, from its first word's
    first to its last word's last character; ``drop_documents`` drops a
    document with any hit. Texts without a hit stay as they are."""
    own, steps = _hit_steps(docs, benchmark, doc_id=doc_id, text=text, **options)
    if action == "drop_documents":
        hits = map_steps(own, steps)
        return hits.where(F.size("first") == 0).select(F.col("id").alias(doc_id), F.col("text").alias(text),
                                                       F.lit(0).cast("long").alias("n_hit"), *[c for c in hits.columns if c == "rest"])
    if action != "remove_spans":
        raise ValueError(f"unknown action: {action}")
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"`{doc_id}` {kind}, `{text}` string, n_hit bigint"
    if "rest" in own.columns:
        schema += f", {field(own, 'rest')}"
    return map_steps(own, [*steps, (schema, _cut(doc_id, text))])  # hits and cuts in one worker


def _cut(doc_id: str, text: str):
    def cut(batch: pa.RecordBatch):
        names = batch.schema.names
        body = batch.column(names.index("text"))
        first, end = (batch.column(names.index(c)) for c in ("first", "end"))
        texts, hit = body.to_pylist(), []
        for i in range(len(texts)):
            f, e = first[i].as_py(), end[i].as_py()
            hit.append(sum(e) - sum(f))
            if f:
                data = texts[i].encode()
                table = WordTable(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]), ALNUM_WORDS, lower=True)
                edges = [0, *(x for s, t in zip(f, e) for x in (int(table.start[s]), int(table.stop[t - 1]))), len(data)]
                texts[i] = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2])).decode()
        yield {doc_id: batch.column(names.index("id")), text: texts, "n_hit": hit,
               **({"rest": batch.column(names.index("rest"))} if "rest" in names else {})}

    return cut


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of ``benchmark_hits`` over whole ``documents``."""
    hits = benchmark_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), with_text=False)

    return hits.select(
        F.col("id").alias("doc_id"), "n_words",
        F.aggregate(F.zip_with("end", "first", lambda e, f: (e - f).cast("long")), F.lit(0).cast("long"),
                    lambda a, x: a + x).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("first") > 0).alias("contaminated"))


OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(words)) AS k,
         array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS gram
  FROM (SELECT item, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS i FROM iw WHERE len(words) > 0)),
dg AS (
  SELECT doc_id, i, k, array_to_string(words[i:i + k - 1], ' ') AS gram
  FROM (SELECT w.doc_id, w.words, ks.k, unnest(generate_series(1, len(w.words) - ks.k + 1)) AS i
        FROM w, (SELECT DISTINCT k FROM win) ks WHERE len(w.words) >= ks.k)),
hits AS (SELECT dg.doc_id, dg.i, dg.k, win.item FROM dg JOIN win ON dg.gram = win.gram AND dg.k = win.k),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
         SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items
       FROM hits GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(hw.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(hi.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(hi.items, '')) AS items_sha256,
       coalesce(hw.n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hw ON w.doc_id = hw.doc_id LEFT JOIN hi ON w.doc_id = hi.doc_id
"""


def digest(items) -> str:
    """Lower-case hex SHA-256 of comma-joined ids."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()
