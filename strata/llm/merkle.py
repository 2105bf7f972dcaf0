"""Merkle dataset manifest: leaf coordinates by bitmap rank, levels by slots.

Each row's digest is a leaf. Per source, the ids form a compressed bitmap: one
64-bit word for each run of 64 ids that holds any, merged by OR. Words lie in
boxes of 65,536 ids, and popcounts are summed up in directories over boxes,
groups of boxes, and so on (16 bits of the id a level). The rank of an id,
its leaf's position, is read from the directories and the popcount of the
lower bits of its box; leaves are never sorted.

Positions key slot arrays: the task that holds the 4,096 positions of a block
fills its slots and hashes three levels (runs of 16) at once. Block digests go
on to the next round until each tree has one node. The subroots, ordered by
source, go through the same rounds. Sibling digests then travel down: each
block gets the path of its root once, and its leaves fold to the root.

No group holds more than a box or a block, whatever the sources' sizes or the
spread of the ids.

Defined cases: null ids come before all others; rows of one source and id are
ordered by leaf digest, equal rows follow each other (they differ in their
siblings only); a null text has ``-`` as its field, an empty one ``0:``; a null
source is a tree of its own; an empty table gives an empty table; other columns
are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strata.llm.common import read, saved
from strata.llm.ranking import numbered

RUN, LEVELS = 16, 3
BLOCK = RUN**LEVELS
TAMPER_EVERY = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DIRECTORY = ["d3", "d2", "d1"]  # 16 bits of the id each, from the top
#: copies of a row numbered in one step
_COPIES = 4096


# --- leaves -------------------------------------------------------------------

def _digest(docs: DataFrame, text: Column) -> Column:
    def part(value):
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``tree`` (the source, told apart from null), ``doc_id``, ``leaf`` and
    ``tampered``: the leaf after tampering, null where that changes nothing."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    lowered = F.translate("text", _UPPER, _LOWER)
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        _digest(docs, F.col("text")).alias("leaf"),
        F.when(hit & (lowered != F.col("text")), _digest(docs, lowered)).alias("tampered"))


# --- ranks --------------------------------------------------------------------

def bitmap_words(keys: DataFrame) -> DataFrame:
    """Compressed bitmaps of ``keys(tree, key, w)``: for each box the words
    with any bit set, by ``word`` number. A key counts ``w`` times; bitmap
    ``slice`` j holds the keys whose count has bit j, so plain keys are all in
    slice 0."""
    slices = F.when(F.col("w") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.lit(62)), lambda j: F.getbit(F.col("w"), j) == 1))
    bit = F.expr("shiftleft(1L, d0 & 63)")
    return (keys.select("tree", *_DIRECTORY, F.shiftright("d0", 6).alias("word"), bit.alias("bit"), F.explode(slices).alias("slice"))
            .groupBy("tree", *_DIRECTORY, "word", "slice").agg(F.bit_or("bit").alias("bits")))


def directories(words: DataFrame) -> DataFrame:
    """For each box: ``base``, the keys of the tree in lower boxes, and ``n``,
    all keys of the tree. Prefix sums of one level run over the at most 65,537
    entries below one entry of the level above."""
    counts = words.groupBy("tree", *_DIRECTORY).agg(F.sum(F.expr("shiftleft(cast(bit_count(bits) as long), slice)")).alias("n"))
    out = saved(counts.withColumnRenamed("n", "n_d1"), "merkle-boxes")
    levels = [out]
    for up in (2, 1, 0):
        key = ["tree", *_DIRECTORY[:up]]
        levels.append(levels[-1].groupBy(*key).agg(F.sum(f"n_{_DIRECTORY[up]}").alias(f"n_{_DIRECTORY[up - 1]}" if up else "n")))
    total = F.lit(0)
    for i, level in enumerate(levels[:-1]):
        digit, key = _DIRECTORY[2 - i], ["tree", *_DIRECTORY[:2 - i]]
        before = Window.partitionBy(*key).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn(f"b_{digit}", F.coalesce(F.sum(f"n_{digit}").over(before), F.lit(0))).drop(f"n_{digit}")
        out = level if i == 0 else out.join(level, [*key, digit])
        total = total + F.col(f"b_{digit}")
    return out.join(levels[-1], "tree").select("tree", *_DIRECTORY, total.alias("base"), "n")


def with_ranks(rows: DataFrame, key: str, weight: Column, carried: list[str]) -> DataFrame:
    """``rows`` of distinct (tree, key) with ``pos``, the summed weights of the
    smaller keys of the tree, and ``n``, the sum of all; null keys come first."""
    def digit(shift):
        return F.coalesce(F.shiftright(key, shift).bitwiseAND(F.lit(0xFFFF)).cast("int"), F.lit(0))
    keyed = rows.select(
        "tree", F.coalesce((F.shiftright(key, 48) + F.lit(32769)).cast("int"), F.lit(0)).alias("d3"),
        digit(32).alias("d2"), digit(16).alias("d1"), digit(0).alias("d0"), weight.cast("long").alias("w"), *carried)
    words = saved(bitmap_words(keyed), "merkle-words")
    based = words.join(directories(words), ["tree", *_DIRECTORY])
    kept = ["tree", "w", *carried]
    types = {f.name: f.dataType.simpleString() for f in keyed.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", pos long, n long"

    def rank(rows: pa.Table, bitmap: pa.Table) -> pa.Table:
        word, cut = bitmap.column("word").to_numpy(), bitmap.column("slice").to_numpy().astype(np.uint64)
        bits = bitmap.column("bits").to_numpy().view(np.uint64)
        below = np.zeros(1025, dtype=np.int64)
        np.add.at(below, word + 1, (np.bitwise_count(bits).astype(np.uint64) << cut).astype(np.int64))
        below = np.cumsum(below)
        d0 = rows.column("d0").to_numpy()
        pos = below[d0 >> 6] + bitmap.column("base")[0].as_py()
        lower = (np.uint64(1) << (d0 & 63).astype(np.uint64)) - np.uint64(1)
        for j in np.unique(cut):
            of_slice = np.zeros(1024, dtype=np.uint64)
            of_slice[word[cut == j]] = bits[cut == j]
            pos += (np.bitwise_count(of_slice[d0 >> 6] & lower).astype(np.uint64) << j).astype(np.int64)
        n = np.full(len(pos), bitmap.column("n")[0].as_py(), dtype=np.int64)
        return rows.select(kept).append_column("pos", pa.array(pos)).append_column("n", pa.array(n))

    box = ["tree", *_DIRECTORY]
    return keyed.groupBy(*box).cogroup(based.groupBy(*box)).applyInArrow(rank, schema)


def positions(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``pos``, each one's place in its tree, and ``n``, the
    size of the tree. An id that occurs once in its source has its rank; rows
    of a repeated id are ranked among themselves by the first 60 bits of the
    digest, then by the digest."""
    ids = saved(leaves.groupBy("tree", "doc_id").agg(
        F.count(F.lit(1)).alias("w"), F.min("leaf").alias("leaf"), F.min("tampered").alias("tampered")), "merkle-ids")
    ranked = saved(with_ranks(ids, "doc_id", F.col("w"), ["doc_id", "leaf", "tampered"]), "merkle-ranks")
    single = ranked.where("w = 1").select("tree", "doc_id", "leaf", "tampered", "pos", "n")
    repeated = ranked.where("w > 1").select(F.col("tree").alias("_tree"), F.col("doc_id").alias("_id"), "pos", "n")
    if repeated.isEmpty():
        return single
    rows = (leaves.join(repeated, F.col("tree").eqNullSafe(F.col("_tree")) & F.col("doc_id").eqNullSafe(F.col("_id")))
            .groupBy("tree", "doc_id", "pos", "n", "leaf").agg(F.count(F.lit(1)).alias("copies"), F.min("tampered").alias("tampered")))
    own = F.concat("tree", F.lit("|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    short = F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long")
    alike = rows.groupBy(own.alias("tree"), short.alias("short"), F.col("tree").alias("source"), "doc_id",
                         F.col("pos").alias("start"), F.col("n").alias("size")).agg(
        F.sum("copies").alias("w"), F.array_sort(F.collect_list(F.struct("leaf", "tampered", "copies"))).alias("alike"))
    ranked = with_ranks(saved(alike, "merkle-repeats"), "short", F.col("w"), ["source", "doc_id", "start", "size", "alike"])
    before = F.aggregate(F.slice("alike", F.lit(1), F.col("i")), F.lit(0).cast("long"), lambda a, x: a + x["copies"])
    chunks = (ranked.select("source", "doc_id", "size", (F.col("start") + F.col("pos")).alias("start"), "alike", F.posexplode("alike").alias("i", "x"))
              .select("source", "doc_id", "size", "x.*", (F.col("start") + before).alias("start"))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {_COPIES}")))))
    last = F.least(F.lit(_COPIES).cast("long"), F.col("copies") - F.col("chunk") * _COPIES) - 1
    numbers = (chunks.repartition("source", "doc_id", "leaf", "chunk")
               .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last))))
    return single.unionByName(numbers.select(
        F.col("source").alias("tree"), "doc_id", "leaf", "tampered",
        (F.col("start") + F.col("chunk") * _COPIES + F.col("k")).alias("pos"), F.col("size").alias("n")))


# --- levels -------------------------------------------------------------------

def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _levels(n: int) -> int:
    """Levels that one round reduces in a tree of n nodes."""
    k = 0
    while n > 1 and k < LEVELS:
        n, k = -(-n // RUN), k + 1
    return k


def _reduced(n: int) -> int:
    for _ in range(_levels(n)):
        n = -(-n // RUN)
    return n


def _slots(rows: pa.Table, name: str) -> tuple[list, int, int]:
    """The slot array of a block, its first position, and the tree's size."""
    pos, n = rows.column("pos").to_numpy(), rows.column("n")[0].as_py()
    start = int(pos[0]) // BLOCK * BLOCK
    out = [None] * len(pos)
    for at, digest in zip((pos - start).tolist(), rows.column(name).to_pylist()):
        out[at] = digest
    return out, start, n


def _runs(digests: list[str]) -> list[str]:
    return ["".join(digests[i:i + RUN]) for i in range(0, len(digests), RUN)]


def _block_sides(digests: list[str], levels: int) -> tuple[list[list[tuple[str, str]]], str]:
    """For each slot its (left, right) siblings level by level, and the digest
    of the block."""
    sides = [[] for _ in digests]
    width = 1
    for _ in range(levels):
        runs = _runs(digests)
        for slot, own in enumerate(sides):
            node = slot // width
            run, k = runs[node // RUN], node % RUN * 64
            own.append((run[:k], run[k + 64:]))
        digests, width = [_sha(r) for r in runs], width * RUN
    return sides, digests[0]


def _up(rows: pa.Table) -> pa.Table:
    digests, start, n = _slots(rows, "digest")
    for _ in range(_levels(n)):
        digests = [_sha(r) for r in _runs(digests)]
    return pa.table({"tree": rows.column("tree")[:1], "pos": pa.array([start // BLOCK], pa.int64()),
                     "n": pa.array([_reduced(n)], pa.int64()), "digest": digests})


def reduce_trees(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of ``nodes(tree, pos, n, digest)``, the first being the given
    rows, and ``(tree, digest)`` of the trees' roots."""
    rounds = [nodes]
    while not rounds[-1].where("n > 1").isEmpty():
        block = F.expr(f"pos div {BLOCK}").alias("block")
        upper = (rounds[-1].where("n > 1").select("tree", "pos", "n", "digest").groupBy("tree", block)
                 .applyInArrow(_up, "tree string, pos long, n long, digest string"))
        rounds.append(saved(upper, "merkle-round"))
    roots = rounds[0].where("n = 1").select("tree", "digest")
    for r in rounds[1:]:
        roots = roots.unionByName(r.where("n = 1").select("tree", "digest"))
    return rounds, roots


_PATH = "subroot string, root string, lefts array<string>, rights array<string>"


def _with_path(nodes: DataFrame, upper: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` over each block of nodes and the path of its root."""
    block = F.expr(f"pos div {BLOCK}").alias("block")
    upper = upper.select(F.col("tree").alias("of_tree"), F.col("pos").alias("of_block"), "subroot", "root", "lefts", "rights")
    return nodes.groupBy("tree", block).cogroup(upper.groupBy("of_tree", "of_block")).applyInArrow(fn, schema)


def _paths(name: str, extra: list[str]):
    def run(rows: pa.Table, upper: pa.Table) -> pa.Table:
        if not upper.num_rows or not rows.num_rows:
            return pa.table({"tree": pa.array([], pa.string()), **{c: pa.array([], pa.string()) for c in extra}, "pos": pa.array([], pa.int64()),
                             "subroot": pa.array([], pa.string()), "root": pa.array([], pa.string()),
                             "lefts": pa.array([], pa.list_(pa.string())), "rights": pa.array([], pa.list_(pa.string()))})
        digests, start, n = _slots(rows, name)
        sides, _ = _block_sides(digests, _levels(n))
        up = upper.to_pylist()[0]
        at = (rows.column("pos").to_numpy() - start).tolist()
        return pa.table({
            "tree": rows.column("tree"), **{c: rows.column(c) for c in extra}, "pos": rows.column("pos"),
            "subroot": pa.array([up["subroot"]] * len(at), pa.string()), "root": pa.array([up["root"]] * len(at), pa.string()),
            "lefts": pa.array([[x for x, _ in sides[a]] + up["lefts"] for a in at], pa.list_(pa.string())),
            "rights": pa.array([[x for _, x in sides[a]] + up["rights"] for a in at], pa.list_(pa.string()))})
    return run


def block_paths(rounds: list[DataFrame], roots: DataFrame) -> DataFrame:
    """Paths of the block roots of the first round: ``tree, pos`` and the
    siblings from there up to the root, given those of each tree's root
    (``roots``: tree, subroot, root, lefts, rights)."""
    of_root = roots.withColumn("pos", F.lit(0).cast("long"))
    path = None
    for nodes in reversed(rounds[1:]):
        ended = of_root.join(nodes.where("n = 1").select("tree"), "tree", "left_semi")
        if path is not None:
            lower = _with_path(nodes.where("n > 1").select("tree", "pos", "n", "digest"), path, _paths("digest", []), f"tree string, pos long, {_PATH}")
            ended = ended.unionByName(lower)
        path = saved(ended, "merkle-paths")
    ended = of_root.join(rounds[0].where("n = 1").select("tree"), "tree", "left_semi")
    return ended if path is None else ended.unionByName(path)


# --- manifest -----------------------------------------------------------------

def _prove(rows: pa.Table, upper: pa.Table) -> pa.Table:
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    if not rows.num_rows:
        kinds = (pa.int64(), *[pa.string()] * 5, pa.bool_())
        return pa.table({c: pa.array([], t) for c, t in zip(names, kinds)})
    digests, start, n = _slots(rows, "leaf")
    sides, _ = _block_sides(digests, _levels(n))
    up = upper.to_pylist()[0]
    above = list(zip(up["lefts"], up["rights"]))
    tail = hashlib.sha256
    end = "".join(a + b for a, b in above).encode("ascii")
    proofs, folded = [], []
    for at, leaf, other in zip((rows.column("pos").to_numpy() - start).tolist(), rows.column("leaf").to_pylist(), rows.column("tampered").to_pylist()):
        proof = tail("".join(a + b for a, b in sides[at]).encode("ascii"))
        proof.update(end)
        proofs.append(proof.hexdigest())
        now = other or leaf
        for a, b in (*sides[at], *above):
            now = _sha(a + now + b)
        folded.append(now)
    k = rows.num_rows
    return pa.table([rows.column("doc_id"), rows.column("leaf"), pa.array([up["subroot"]] * k, pa.string()), pa.array([up["root"]] * k, pa.string()),
                     pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array([x == up["root"] for x in folded], pa.bool_())], names=list(names))


def manifest(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``leaf``, ``subroot`` of
    its source, ``root``, ``proof_sha256`` over its siblings, ``folded_root``
    from the tampered leaf, and whether that is the root."""
    placed = saved(positions(saved(leaves(docs), "merkle-leaves")), "merkle-positions")
    rounds, subroots = reduce_trees(placed.withColumnRenamed("leaf", "digest"))
    # "-" (null) sorts before "=...", sources sort bytewise behind it
    named = numbered(subroots.select(F.col("tree").alias("source"), "digest"), [F.col("source")], "merkle-subroots")
    size = named.agg(F.count(F.lit(1)).alias("n"))
    named = saved(named.join(F.broadcast(size)).withColumn("tree", F.lit("")), "merkle-sources")
    top, root = reduce_trees(named)
    over = root.select("tree", F.col("digest").alias("subroot"), F.col("digest").alias("root"),
                       F.array().cast("array<string>").alias("lefts"), F.array().cast("array<string>").alias("rights"))
    sources = _with_path(named.select("tree", "source", "digest", "pos", "n"), block_paths(top, over), _paths("digest", ["source"]),
                         f"tree string, source string, pos long, {_PATH}")
    sources = sources.drop("subroot", "tree", "pos").join(named.select("source", F.col("digest").alias("subroot")), "source")
    paths = block_paths(rounds, saved(sources.select(F.col("source").alias("tree"), "subroot", "root", "lefts", "rights"), "merkle-tops"))
    return _with_path(placed.select("tree", "doc_id", "leaf", "tampered", "pos", "n"), paths, _prove,
                      "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read(spark, sf_dir, "documents"))


_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
  lambda r, b: list_reduce(list_prepend(xor(r, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, z: xor(x >> 1, (x & 1) * 3988292384::bigint))), 4294967295::bigint)"""


def _sql_levels(name: str, first: str, levels: int) -> str:
    """CTEs of a tree's levels and, for each node of the first, of its
    siblings' text (``proof``), fold and root."""
    out = [f"{name}0 as ({first})"]
    for i in range(levels):
        out.append(f"""{name}{i + 1} as (
  select tree, pos // 16 as pos, case when max(n) > 1 then (max(n) + 15) // 16 else 1 end as n,
         case when max(n) > 1 then sha256(string_agg(digest, '' order by pos)) else min(digest) end as digest
  from {name}{i} group by tree, pos // 16)""")
    for i in range(levels):
        out.append(f"""{name}_sides{i} as (
  select tree, pos, n, coalesce(string_agg(digest, '') over (w rows between unbounded preceding and 1 preceding), '') as l,
         coalesce(string_agg(digest, '') over (w rows between 1 following and unbounded following), '') as r
  from {name}{i} window w as (partition by tree, pos // 16 order by pos))""")
    return ",\n".join(out)


def _sql_fold(name: str, start: str, levels: int) -> str:
    """CTEs that carry ``proof`` and ``fold`` of ``start`` up, level by level."""
    out = []
    for i in range(levels):
        out.append(f"""{name}_fold{i + 1} as (
  select f.* exclude (proof, fold, slot), f.slot // 16 as slot, f.proof || s.l || s.r as proof,
         case when s.n > 1 then sha256(s.l || f.fold || s.r) else f.fold end as fold
  from {start if i == 0 else f"{name}_fold{i}"} f join {name}_sides{i} s on s.tree = f.{name}_tree and s.pos = f.slot)""")
    return ",\n".join(out)


_FIELD = "case when {0} is null then '-' else strlen({0}::varchar) || ':' || {0} end"
_FIELDS = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
OP11_SQL = f"""
with made as (
  select doc_id, coalesce('=' || source, '-') as tree, sha256({_FIELDS} || {_FIELD.format("text")}) as leaf,
         case when {_CRC} % 5 = 0 then sha256({_FIELDS} || {_FIELD.format("translate(text, '" + _UPPER + "', '" + _LOWER + "')")}) end as tampered
  from documents),
placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n from made),
{_sql_levels("doc", "select tree, pos, n, leaf as digest from placed", 7)},
{_sql_levels("src", "select '' as tree, row_number() over (order by tree) - 1 as pos, count(*) over () as n, digest, tree as source from doc7", 5)},
roots as (select digest as root from src5),
started as (
  select p.doc_id, p.leaf, p.tree as doc_tree, '' as src_tree, p.pos as slot, s.pos as src_pos, s.digest as subroot, r.root,
         '' as proof, coalesce(p.tampered, p.leaf) as fold
  from placed p join src0 s on s.source = p.tree cross join roots r),
{_sql_fold("doc", "started", 7)},
turned as (select * exclude (slot, src_pos), src_pos as slot from doc_fold7),
{_sql_fold("src", "turned", 5)}
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, fold as folded_root, fold = root as verified from src_fold5
"""
