"""Removal of passages that repeat across documents, by phrase automata.

Words are runs of anything but ASCII white space. A window is ``window``
consecutive words; a word goes if a window that covers it also starts in a
document with a smaller id.

1. Every document's words are digested. Of equal word sequences only the one
   with the smallest id takes part further (the representative): a copy of
   ``window`` words or more goes whole, a shorter one has no window.
2. Anchors: of the ``PHRASE``-word phrases in a window the one with the least
   hash. Equal windows have equal anchors, so a window can recur only if its
   anchor does. Anchor phrases are counted on their own text; those of two or
   more different word sequences are the recurring phrases.
3. Documents are dealt to blocks by digest. Each block gets the recurring
   phrases that occur in it, compiles them into an Aho-Corasick automaton (one
   shard of the whole) and streams its documents through it; every window
   whose anchor is located there becomes a (window hash, document, place) row.
4. The smallest document of each window, and with it the words to remove.

Automata hold only phrases of their own block, so they stay bounded and the
work grows with the input. Blooms of bounded size keep texts without any
recurring phrase out of the shuffles; a false positive costs work, never a
result. A window that a third of all documents hold is pre-aggregated in its
block and in the map tasks; the join back is left to skew-join splitting.

Defined cases: null and empty texts have no words; rows with one id are no
copies of one another unless another id is smaller; a null id neither owns a
window nor loses words; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import bloom
from strata.llm.common import discard, field, map_arrow, others, read, saved
from strata.llm.words import SPACE_WORDS, WordTable, covered, text_runs

WINDOW = 50
PHRASE = 5
BLOCK_BYTES = 4 << 20
EMPTY = hashlib.sha256(b"").hexdigest()


def single_spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with their words joined by one space; new bytes and offsets."""
    inside = SPACE_WORDS[data]
    gap = np.zeros(len(data), dtype=bool)
    gap[1:] = inside[:-1] & ~inside[1:]
    gap[offsets[:-1][offsets[:-1] < len(data)]] = False
    # the gap after a text's last word goes
    last_word = np.maximum.accumulate(np.where(inside, np.arange(len(data)), -1)) if len(data) else np.empty(0, np.int64)
    for_doc = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    end = last_word[for_doc]
    lo = offsets[:-1][offsets[1:] > offsets[:-1]]
    drop = end[(end >= lo) & (end < for_doc)] + 1
    keep = inside | gap
    keep[drop] = False
    out = np.where(inside, data, np.uint8(0x20))[keep]
    table = np.concatenate(([0], np.cumsum(keep)))
    return out, table[offsets]


def spaced_tables(texts: pa.Array):
    """(first row, end row, WordTable of the single-spaced texts)."""
    for a, b, data, offsets in text_runs(texts):
        data, offsets = single_spaced(data, offsets)
        yield a, b, WordTable(data, offsets, SPACE_WORDS, lower=False)


def doc_digests(table: WordTable) -> list[bytes]:
    raw = table.data
    return [hashlib.sha256(raw[s:e]).digest() for s, e in zip(table.offsets[:-1].tolist(), table.offsets[1:].tolist())]


def short(digests: list[bytes]) -> np.ndarray:
    """First eight bytes of each digest as a signed 64-bit number."""
    return np.frombuffer(b"".join(x[:8] for x in digests), dtype="<i8").astype(np.int64)


def anchor_values(table: WordTable, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrase hashes, the least of each window, and which windows lie in one text."""
    hashes = table.windows(phrase)
    width = window - phrase + 1
    n = len(table.hashes) - window + 1
    if n <= 0:
        return hashes, np.empty(0, dtype=np.uint64), np.empty(0, dtype=bool)
    least, have = hashes, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have:])
    return hashes, least[:n], table.within(window)


def anchors(table: WordTable, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors of each text: text number, first word, phrase hash."""
    hashes, least, valid = anchor_values(table, window, phrase)
    at = np.flatnonzero(valid)
    if not len(at):
        return (np.empty(0, dtype=np.int64),) * 2 + (np.empty(0, dtype=np.uint64),)
    change = np.ones(len(at), dtype=bool)
    change[1:] = (least[at[1:]] != least[at[:-1]]) | (at[1:] != at[:-1] + 1)
    at = at[change]
    doc, value = table.doc()[at], least[at]
    order = np.lexsort((value, doc))
    doc, value, at = doc[order], value[order], at[order]
    keep = np.ones(len(doc), dtype=bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value, at = doc[keep], value[keep], at[keep]
    first = np.empty(len(at), dtype=np.int64)
    width = window - phrase + 1
    for a in range(0, len(at), 4096):
        part = hashes[at[a:a + 4096, None] + np.arange(width)]
        first[a:a + 4096] = at[a:a + 4096] + np.argmax(part == value[a:a + 4096, None], axis=1)
    return doc, first, value


def phrase_bytes(table: WordTable, first: np.ndarray, phrase: int) -> list[bytes]:
    raw = table.data.tobytes()
    return [raw[s:e] for s, e in zip(table.start[first].tolist(), table.stop[first + phrase - 1].tolist())]


def digest_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, digest (SHA-256 of the words joined by one space), words, bytes."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def scan(batch: pa.RecordBatch):
        for a, b, table in spaced_tables(batch.column(1)):
            yield {"id": batch.column(0).slice(a, b - a), "sha": doc_digests(table),
                   "n_words": np.diff(table.bounds), "n_bytes": np.diff(table.offsets)}

    return map_arrow(docs.select(doc_id, text), f"id {kind}, sha binary, n_words bigint, n_bytes bigint", scan)


def recurring_phrases(docs: DataFrame, doc_id: str, text: str, window: int, phrase: int, blocks: int) -> DataFrame:
    """phrase, hash, blocks: anchor phrases of two or more word sequences."""

    def scan(batch: pa.RecordBatch):
        for a, b, table in spaced_tables(batch.column(0)):
            doc, first, value = anchors(table, window, phrase)
            if len(doc):
                sha = short(doc_digests(table))[doc]
                seen, keep = set(), []
                for i, x in enumerate(zip(sha.tolist(), value.tolist())):  # copies in one run of texts count once
                    if x not in seen:
                        seen.add(x)
                        keep.append(i)
                yield {"phrase": phrase_bytes(table, first[keep], phrase), "hash": value[keep].view(np.int64), "sha": sha[keep]}

    rows = map_arrow(docs.select(text), "phrase binary, hash bigint, sha bigint", scan)
    return (rows.groupBy("phrase")
            .agg(F.min("sha").alias("lo"), F.max("sha").alias("hi"), F.first("hash").alias("hash"),
                 F.collect_set(F.pmod("sha", F.lit(blocks)).cast("int")).alias("blocks"))
            .where(F.col("lo") != F.col("hi")).select("phrase", "hash", "blocks"))


def automaton(phrases: list[bytes]) -> ahocorasick.Automaton:
    """Automaton of phrases bounded by spaces; bytes are taken as characters
    one to one, so places are byte offsets."""
    out = ahocorasick.Automaton()
    for p in phrases:
        out.add_word(f" {p.decode('latin-1')} ", len(p))
    out.make_automaton()
    return out


def located(table: WordTable, found: ahocorasick.Automaton) -> np.ndarray:
    """First words of all occurrences of the automaton's phrases."""
    starts = []
    raw = table.data.tobytes().decode("latin-1")
    for s, e in zip(table.offsets[:-1].tolist(), table.offsets[1:].tolist()):
        # one space before and after; a hit's last character is the space after it
        starts += [s + end - n - 1 for end, n in found.iter(f" {raw[s:e]} ")]
    return np.searchsorted(table.start, np.array(starts, dtype=np.int64))


def block_windows(docs: pa.Table, phrases: pa.Table, window: int, phrase: int):
    """Windows of a block's documents whose anchor the automaton locates."""
    ids, texts = docs.column("id"), docs.column("text").combine_chunks()
    automata = automaton(phrases.column("phrase").to_pylist())
    shas = docs.column("sha").to_numpy()
    for a, b, table in spaced_tables(texts):
        hashes, least, valid = anchor_values(table, window, phrase)
        if not valid.any():
            continue
        known = np.unique(hashes[located(table, automata)])
        at = np.flatnonzero(valid)
        at = at[np.isin(least[at], known)] if len(known) else at[:0]
        doc = table.doc()[at]
        yield ids.slice(a, b - a), shas[a:b], doc, table.windows(window)[at], at - table.bounds[doc]


def window_rows(docs: DataFrame, phrases: DataFrame, id_kind: str, window: int, phrase: int) -> DataFrame:
    """id, sha, place, hash of every window that may recur; by block."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = f"id {id_kind}, sha bigint, place int, hash bigint"
    target = to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            for ids, shas, doc, hashes, place in block_windows(left, right, window, phrase):
                parts.append(pa.Table.from_arrays([
                    ids.take(pa.array(doc)).combine_chunks().cast(target.field(0).type), pa.array(shas[doc]),
                    pa.array(place, pa.int32()), pa.array(hashes.view(np.int64))], schema=target))
        return pa.concat_tables(parts) if parts else target.empty_table()

    return docs.groupBy("block").cogroup(phrases.groupBy("block")).applyInArrow(run, schema)


def repeated_words(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   phrase: int = PHRASE, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Two tables. ``digests``: id, sha, n_words, copy (whether an equal word
    sequence has a smaller id), one row per row of ``docs``. ``places``: id,
    sha (its first eight bytes), places: the first words of the windows to
    remove, one row per representative that has any."""
    kind = docs.schema[doc_id].dataType.simpleString()
    digests = saved(digest_table(docs, doc_id, text), "digests")
    total, = digests.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    blocks = max(1, -(-total // block_bytes))
    owners = digests.groupBy("sha").agg(F.min("id").alias("owner"))
    classes = saved(digests.join(owners, "sha").withColumn("copy", F.coalesce(F.col("id") > F.col("owner"), F.lit(False))),
                    "classes")
    discard(digests)
    digests = classes
    phrases = saved(recurring_phrases(docs, doc_id, text, window, phrase, blocks), "phrases")
    n_phrases = phrases.count()
    known = docs.sparkSession.sparkContext.broadcast(bloom.build(phrases, "hash", bloom.bits_for(n_phrases)))

    def involved(batch: pa.RecordBatch):
        for a, b, table in spaced_tables(batch.column(1)):
            doc, _, value = anchors(table, window, phrase)
            rows = np.unique(doc[known.value.has(value)])
            if len(rows):
                part = batch.slice(a, b - a).take(pa.array(rows))
                digests_ = doc_digests(table)
                sha = short([digests_[i] for i in rows])
                yield {"id": part.column(0), "text": part.column(1), "sha": sha, "block": sha % blocks}

    reps = digests.where(~F.col("copy")).select(F.col("id").alias("rid"), F.col("sha").alias("rsha")).distinct()
    texts = map_arrow(docs.select(doc_id, text), f"id {kind}, text string, sha bigint, block int", involved)
    texts = texts.join(reps.select("rid", first_eight("rsha").alias("rsha")),
                       F.col("id").eqNullSafe(F.col("rid")) & (F.col("sha") == F.col("rsha")), "left_semi")
    shards = phrases.select(F.explode("blocks").alias("block"), "phrase")
    rows = saved(window_rows(texts, shards, kind, window, phrase), "windows")
    discard(phrases)
    owner = (rows.groupBy("hash").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
             .where(F.col("owner") < F.col("last")).select("hash", "owner"))
    places = saved(rows.join(owner, "hash").where(F.col("id") > F.col("owner"))
                   .groupBy("id", "sha").agg(F.collect_set("place").alias("places")), "places")
    discard(rows)
    return digests, places


def first_eight(column: str):
    """A digest's first eight bytes as a little-endian signed number, as ``short`` has it."""
    order = F.concat(*[F.substring(F.hex(F.col(column)), 2 * i + 1, 2) for i in range(7, -1, -1)])
    return F.conv(order, 16, -10).cast("long")


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   phrase: int = PHRASE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, sha (of the input words), n_words, n_removed, kept (the kept words
    joined by one space where any word went, else null), kept_sha: one row per
    row of ``docs``."""
    kind = docs.schema[doc_id].dataType.simpleString()
    digests, places = repeated_words(docs, doc_id=doc_id, text=text, window=window, phrase=phrase, block_bytes=block_bytes)
    n = places.count()
    keys = bloom.build(places.select(F.xxhash64("id").alias("k")), "k", bloom.bits_for(n))
    sent = docs.sparkSession.sparkContext.broadcast(keys)

    def candidates(batch: pa.RecordBatch):
        rows = np.flatnonzero(sent.value.has(batch.column(2).to_numpy()))
        part = batch.take(pa.array(rows))
        for a, b, table in spaced_tables(part.column(1)):
            yield {"id": part.column(0).slice(a, b - a), "text": part.column(1).slice(a, b - a), "tsha": short(doc_digests(table))}

    texts = map_arrow(docs.select(doc_id, text, F.xxhash64(doc_id)).where(F.col(doc_id).isNotNull()),
                      f"id {kind}, text string, tsha bigint", candidates)
    hit = texts.join(places, (texts.id == places.id) & (texts.tsha == places.sha)).select(texts.id, "sha", "text", "places")

    def cut(batch: pa.RecordBatch):
        names = batch.schema.names
        col = {c: batch.column(names.index(c)) for c in names}
        for a, b, table in spaced_tables(col["text"]):
            kept, gone = [], []
            raw = table.data.tobytes()
            for d in range(b - a):
                lo, hi = int(table.bounds[d]), int(table.bounds[d + 1])
                starts = np.array(col["places"][a + d].as_py(), dtype=np.int64)
                mask = covered(starts, window, hi - lo)
                left = np.flatnonzero(~mask) + lo
                kept.append(b" ".join(raw[s:e] for s, e in zip(table.start[left].tolist(), table.stop[left].tolist())).decode())
                gone.append(int(mask.sum()))
            yield {"id": col["id"].slice(a, b - a), "sha8": col["sha"].slice(a, b - a), "gone": gone, "kept": kept}

    cuts = map_arrow(hit, f"id {kind}, sha8 bigint, gone bigint, kept string", cut).dropDuplicates(["id", "sha8"])
    whole = F.col("copy") & (F.col("n_words") >= window)
    d = digests.withColumn("sha8", first_eight("sha"))
    out = d.join(cuts.select(F.col("id").alias("cid"), F.col("sha8").alias("csha"), "gone", "kept"),
                 (F.col("id") == F.col("cid")) & (F.col("sha8") == F.col("csha")) & ~F.col("copy"), "left")
    return out.select(
        "id", "sha", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    ).withColumn("kept_sha", F.when(F.col("kept").isNull(), F.lower(F.hex("sha"))).otherwise(F.sha2(F.col("kept").cast("binary"), 256)))


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with repeated words removed from its texts: a text that loses
    words becomes its kept words joined by one space, others stay as they are.
    All columns are returned."""
    out = remove_repeats(docs, doc_id=doc_id, text=text, **options)
    changed = (out.where("n_removed > 0").select(F.col("id").alias("rid"), first_eight("sha").alias("rsha"), F.col("kept").alias("rkept"))
               .dropDuplicates(["rid", "rsha"]))
    rest = others(docs, doc_id, text)
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *([rest] if rest is not None else []))
    schema = f"{', '.join(field(own, c) for c in own.columns)}, word_sha bigint"

    def digest(batch: pa.RecordBatch):
        for a, b, table in spaced_tables(batch.column(1)):
            yield {**{c: batch.column(i).slice(a, b - a) for i, c in enumerate(batch.schema.names)}, "word_sha": short(doc_digests(table))}

    both = map_arrow(own, schema, digest).join(changed, (F.col("id") == F.col("rid")) & (F.col("word_sha") == F.col("rsha")), "left")
    body = F.when(F.col("rid").isNotNull(), F.col("rkept")).otherwise(F.col("text"))
    values = {doc_id: F.col("id"), text: body, **{c: F.col("rest").getField(c) for c in docs.columns if c not in (doc_id, text)}}
    return both.select(*[values[c].alias(c) for c in docs.columns])


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of ``remove_repeats`` over whole ``documents``."""
    out = remove_repeats(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.col("kept_sha").alias("kept_sha256"))


OP10_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM w WHERE len(words) >= 50)),
owner AS (SELECT h, min(doc_id) AS owner FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT win.doc_id, unnest(generate_series(win.i, win.i + 49)) AS p FROM win JOIN owner USING (h) WHERE owner.owner < win.doc_id)),
gl AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, w.words, coalesce(gl.n, 0) AS n,
         CASE WHEN gl.n IS NULL THEN w.words
              ELSE [w.words[j] FOR j IN generate_series(1, len(w.words)) IF NOT list_contains(gl.ps, j)] END AS k
  FROM w LEFT JOIN gl ON w.doc_id = gl.doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed,
       sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""
