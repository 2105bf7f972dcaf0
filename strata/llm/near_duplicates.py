"""Exact n-gram Jaccard join by signature trees.

A document's set holds its distinct word shingles (64-bit hashes); documents
link when 100 * intersection >= percent * union. Sets that are equal form one
class, which is named by its smallest id; classes are the nodes, known by a
key of one row's id and text, and only nodes are joined.

Cells. Two sets of the similarity share a token among the first
n - ceil(n * percent / 100) + 1 tokens of each in any order of tokens that is
the same for all. The order here is by hash, tokens of many classes last (a
Bloom filter of them is one fixed set, whatever its false positives). Nodes
that share such a token form a cell. Cells of the same nodes count once.

Stars. In each cell every node is paired with the node that is in most cells,
as the origin of a group of near copies is; pairs that bitmaps allow are
verified on the texts, and links give components.

Trees. Only cells with nodes of two or more components are left. There the
nodes outside the cell's largest component meet all its nodes in a dual
traversal of signature trees (``signature_tree``), which prunes node pairs by
size, by possible overlap and by component. Each node's most promising
survivors are verified first (``ROUNDS``), and join the components, before the
cells that had more survivors are traversed again; the last round verifies all
that are left. A pair within one component is never compared.

So each pair that could change a component is either pruned by a bound or
verified exactly, while a group of thousands of near copies costs a star.
Cells are dealt out in chunks of bounded size.

All links. ``near_duplicates`` takes that shortcut, and its links are those
that join components. ``class_links`` is the full join: all nodes of each cell
meet in the traversal, each as a component of its own, and every pair that
sizes and bitmaps allow is verified. Its work and its rows grow with the
square of a group of near copies; copies of one set stay one class.

Defined cases: a null or empty text, and one of separators only, has an empty
set and links with nothing; rows of one id with different texts are nodes of
their own, so the id may be in several classes and components; a null id takes no part and has a null component; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import bloom, signature_tree as st
from strata.llm.common import discard, field, map_arrow, read, saved
from strata.llm.graph import components
from strata.llm.words import SPACE_WORDS, word_tables

SHINGLE = 5
PERCENT = 80
#: classes that share a token before it is put last; members of a chunk
MANY, CHUNK = 64, 2048
#: survivors of a node and chunk that are verified in each round; the last takes all
ROUNDS = (4, 32, 256, None)
#: members of the cells that are traversed in one group
GROUP_MEMBERS = 20_000
#: the last two where all pairs may survive
LINK_CHUNK, LINK_MEMBERS = 512, 2048
#: text rows dealt to one verification group
GROUP_ROWS = 256


def shingle_sets(texts: pa.Array, k: int):
    """(row, sorted distinct shingle hashes) of each text."""
    for a, b, table in word_tables(texts, SPACE_WORDS, lower=True):
        hashes = table.windows(k)
        for d in range(b - a):
            lo, hi = int(table.bounds[d]), int(table.bounds[d + 1])
            if hi - lo >= k:
                yield a + d, np.unique(hashes[lo:hi - k + 1])
            elif hi > lo:
                yield a + d, _short(table.hashes[lo:hi])
            else:
                yield a + d, np.empty(0, dtype=np.uint64)


def _short(words: np.ndarray) -> np.ndarray:
    """The one token of a text of fewer words than a shingle."""
    raw = hashlib.blake2b(words.tobytes(), digest_size=8).digest()
    return np.frombuffer(raw, dtype=np.uint64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def prefix(tokens: np.ndarray, percent: int, last: bloom.Bloom | None = None) -> np.ndarray:
    """The first tokens by (member of ``last``, hash); tokens are sorted."""
    p = prefix_length(len(tokens), percent)
    if last is None:
        return tokens[:p]
    late = last.has(tokens)
    return np.concatenate((tokens[~late], tokens[late]))[:p]


def _scan(k: int):
    def scan(batch: pa.RecordBatch):
        n, sha = [], []
        for _, tokens in shingle_sets(batch.column(1), k):
            n.append(len(tokens))
            sha.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
        yield {"id": batch.column(0), "n": n, "sha": sha, "doc": batch.column(2)}

    return scan


def _tokens_of(k: int, percent: int):
    """Prefix tokens by hash; equal sets in one batch count once."""

    def scan(batch: pa.RecordBatch):
        seen, parts, size = set(), [], 0
        for _, tokens in shingle_sets(batch.column(0), k):
            sha = hashlib.blake2b(tokens.tobytes(), digest_size=8).digest()
            if len(tokens) and sha not in seen:
                seen.add(sha)
                parts.append(prefix(tokens, percent))
                size += len(parts[-1])
                if size > 200_000:
                    yield {"token": np.concatenate(parts).view(np.int64)}
                    parts, size = [], 0
        if parts:
            yield {"token": np.concatenate(parts).view(np.int64)}

    return scan


def _signatures(k: int, percent: int, last):
    """id, sha, n, prefix, bitmap of every text with a set."""

    def scan(batch: pa.RecordBatch):
        rows, out, size = [], {"sha": [], "n": [], "prefix": [], "bitmap": []}, 0
        for row, tokens in shingle_sets(batch.column(1), k):
            if len(tokens):
                rows.append(row)
                out["sha"].append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                out["n"].append(len(tokens))
                out["prefix"].append(prefix(tokens, percent, last.value).tobytes())
                out["bitmap"].append(st.bitmap(tokens))
                size += len(tokens)
            if size > 500_000:
                yield {"id": batch.column(0).take(pa.array(rows)), **out}
                rows, out, size = [], {c: [] for c in out}, 0
        if rows:
            yield {"id": batch.column(0).take(pa.array(rows)), **out}

    return scan


def _exploded(known):
    """token, node, n of prefix tokens that may be shared."""

    def scan(batch: pa.RecordBatch):
        nodes, sizes = batch.column(0), batch.column(1)
        parts, rows, size = [], [], 0
        for i in range(batch.num_rows):
            tokens = np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.uint64)
            tokens = tokens if known is None else tokens[known.value.has(tokens)]
            parts.append(tokens)
            rows.append(np.full(len(tokens), i))
            size += len(tokens)
            if size > 100_000 or i == batch.num_rows - 1:
                at = pa.array(np.concatenate(rows))
                yield {"token": np.concatenate(parts).view(np.int64), "node": nodes.take(at), "n": sizes.take(at)}
                parts, rows, size = [], [], 0

    return scan


def verified(pairs: DataFrame, texts: DataFrame, kind: str, k: int, percent: int) -> DataFrame:
    """Links a, b, shared, either among distinct pairs of nodes, by their whole
    texts. Each pair meets its first node's text, which is sent once for up to
    ``GROUP_ROWS`` partners; groups are of bounded size."""
    count = pairs.groupBy("a").agg(F.count("*").alias("partners"))
    total, = count.agg(F.coalesce(F.sum("partners"), F.lit(0))).first()
    if not total:
        return pairs.sparkSession.createDataFrame([], f"a {kind}, b {kind}, shared bigint, either bigint")
    groups = -(-total // GROUP_ROWS)
    salts = F.ceil(F.col("partners") / GROUP_ROWS).cast("int")
    cell = F.pmod(F.xxhash64("a", "salt"), F.lit(groups)).alias("g")
    left = (count.select("a", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
            .join(texts, F.col("a") == F.col("id")).select(cell, F.col("a").alias("one"), F.col("text").alias("body")))
    right = (pairs.join(count, "a").withColumn("salt", F.pmod(F.xxhash64("b"), salts).cast("int"))
             .join(texts, F.col("b") == F.col("id")).select(cell, "a", "b", "text"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = f"a {kind}, b {kind}, shared bigint, either bigint"
    target = to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False)

    def run(one: pa.Table, many: pa.Table) -> pa.Table:
        if not one.num_rows or not many.num_rows:
            return target.empty_table()
        names = one.column("one").to_pylist()
        sets = {names[i]: t for i, t in shingle_sets(one.column("body"), k)}
        a = many.column("a").to_pylist()
        keep, shared, either = [], [], []
        for i, y in shingle_sets(many.column("text"), k):
            x = sets[a[i]]
            both = len(np.intersect1d(x, y, assume_unique=True))
            union = len(x) + len(y) - both
            if union and 100 * both >= percent * union:
                keep.append(i)
                shared.append(both)
                either.append(union)
        at = pa.array(keep, pa.int64())
        return pa.Table.from_arrays([many.column("a").take(at).combine_chunks(), many.column("b").take(at).combine_chunks(),
                                     pa.array(shared, pa.int64()), pa.array(either, pa.int64())], schema=target)

    return left.groupBy("g").cogroup(right.groupBy("g")).applyInArrow(run, schema)


def _allowed(percent: int):
    """Keeps pairs whose sizes and bitmaps allow the similarity."""

    def check(batch: pa.RecordBatch):
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        na, nb = c["na"].to_numpy(), c["nb"].to_numpy()
        least = st.needed(na, nb, percent)
        bits = zip(c["ba"].to_pylist(), c["bb"].to_pylist())
        keep = [i for i, (x, y) in enumerate(bits) if min(na[i], nb[i]) >= least[i] and st.max_overlap(x, na[i], y, nb[i]) >= least[i]]
        at = pa.array(keep, pa.int64())
        yield {"a": c["a"].take(at), "b": c["b"].take(at)}

    return check


def _traverse(kind: str, percent: int, most: int | None):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(f"a {kind}, b {kind}, cell bigint"), prefers_large_types=False)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cell", "ascending"), ("i", "ascending"), ("j", "ascending")])
        key = np.stack([table.column(c).to_numpy() for c in ("cell", "i", "j")])
        edge = np.flatnonzero(np.concatenate(([True], np.any(key[:, 1:] != key[:, :-1], axis=0), [True])))
        nodes, sizes, labels = (table.column(c).to_numpy() for c in ("node", "n", "label"))
        bits, lefts = table.column("bitmap").to_pylist(), table.column("minor").to_numpy(zero_copy_only=False)
        parts = [(np.empty(0, dtype=np.int64),) * 4]
        for lo, hi in zip(edge[:-1], edge[1:]):
            at = np.arange(lo, hi)
            one, two = at[lefts[lo:hi]], at[~lefts[lo:hi]]
            if len(one) and len(two):
                x, y, bound = st.candidates(*(([bits[r] for r in rows], sizes[rows], labels[rows]) for rows in (one, two)), percent)
                parts.append((nodes[one[x]], nodes[two[y]], bound, np.full(len(x), key[0][lo])))
        x, y, bound, cell = map(np.concatenate, zip(*parts))
        _, once = np.unique(np.stack((x, y)), axis=1, return_index=True)  # cells share pairs
        once = once[np.lexsort((y[once], -bound[once], x[once]))]  # of each node the likeliest first
        start = np.flatnonzero(np.concatenate(([True], x[once][1:] != x[once][:-1]))) if len(once) else once
        count = np.diff(np.append(start, len(once)))
        place = np.arange(len(once)) - np.repeat(start, count)
        pair, rest = once[place < (most or len(x))], once[place >= (most or len(x))]
        left = np.unique(cell[np.isin(x, x[rest])])  # cells to traverse again
        none = pa.nulls(len(left), target.field(0).type)
        return pa.concat_tables([
            pa.Table.from_arrays([pa.array(np.minimum(x[pair], y[pair]), target.field(0).type),
                                  pa.array(np.maximum(x[pair], y[pair]), target.field(1).type), pa.nulls(len(pair), pa.int64())], schema=target),
            pa.Table.from_arrays([none, none, pa.array(left, pa.int64())], schema=target)])

    return run


def residual_pairs(cells: DataFrame, labels: DataFrame, nodes: DataFrame, kind: str, percent: int, most: int | None,
                   chunk: int | None = None, group_members: int | None = None) -> DataFrame:
    """Candidate pairs a, b of different components, by dual traversal in
    cells, the ``most`` likeliest of each node; and, with null a and b, the cells
    that may have more.

    Cells of one component are traversed in one group, as they share pairs, up
    to ``GROUP_MEMBERS`` members.

    ``cells``: cell, node; ``labels``: node, component; ``nodes``: node, n,
    bitmap."""
    chunk, group_members = chunk or CHUNK, group_members or GROUP_MEMBERS
    member = cells.join(labels, "node", "left").select("cell", "node", F.coalesce("component", "node").alias("label"))
    by_label = member.groupBy("cell", "label").agg(F.count("*").alias("m"))
    mixed = saved(by_label.groupBy("cell")
                  .agg(F.max_by("label", F.struct("m", "label")).alias("major"), F.sum("m").alias("m"),
                       F.max("m").alias("most"), F.count("*").alias("labels"))
                  .where("labels > 1")
                  .select("cell", "major", "m", (F.col("m") - F.col("most")).alias("few"), F.ceil(F.col("m") / chunk).cast("int").alias("chunks"),
                          F.ceil((F.col("m") - F.col("most")) / chunk).cast("int").alias("minors")), "mixed")
    weight = F.expr("m * minors + few * chunks")
    total, = mixed.agg(F.coalesce(F.sum(weight), F.lit(0))).first()
    parts = mixed.groupBy("major").agg(F.ceil(F.sum(weight) / group_members).cast("int").alias("salts"))
    members = saved(member.join(mixed.join(parts, "major"), "cell"), "mixed_members")
    inside = saved(members.select("node").distinct(), "mixed_nodes")
    member = members.join(among(nodes, "node", inside), "node")
    part = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("minors")).cast("int")
    to = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # a node goes to the chunks of all nodes as one of the few, and to the chunks of the few as one of all
    column = ["cell", "node", "n", "bitmap", "label", "major", "salts"]
    few = F.when(F.col("label") != F.col("major"), F.transform(to("chunks"), lambda j: F.struct(own.alias("i"), j.alias("j"), F.lit(True).alias("minor"))))
    every = F.transform(to("minors"), lambda i: F.struct(i.alias("i"), part.alias("j"), F.lit(False).alias("minor")))
    places = F.concat(F.coalesce(few, F.array().cast("array<struct<i:int,j:int,minor:boolean>>")), every)
    rows = member.select(*column, F.explode(places).alias("p")).select(*column, "p.i", "p.j", "p.minor")
    salt = F.pmod(F.xxhash64("cell"), F.col("salts"))
    g = F.pmod(F.xxhash64("major", "i", "j", salt), F.lit(max(1, total // 2048))).alias("g")
    rows = rows.select("cell", "node", "n", "bitmap", "label", "i", "j", "minor", g)
    found = saved(rows.groupBy("g").applyInArrow(_traverse(kind, percent, most), f"a {kind}, b {kind}, cell bigint"), "found")
    discard(mixed, members, inside)
    return found


def node_cells(own: DataFrame, kind: str, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``nodes``: node, n, prefix, bitmap of each class; ``cells``: cell, node.
    Each pair of the similarity has a cell in common."""
    spark = own.sparkSession
    tokens = map_arrow(own.select("text"), "token bigint", _tokens_of(shingle, percent))
    many = saved(tokens.groupBy("token").agg(F.count("*").alias("c")).where(F.col("c") > MANY).select("token"), "many")
    last = spark.sparkContext.broadcast(bloom.build(many, "token", bloom.bits_for(many.count(), 16)))
    rows = map_arrow(own.where(F.col("id").isNotNull()), f"id {kind}, sha binary, n bigint, prefix binary, bitmap binary",
                     _signatures(shingle, percent, last))
    nodes = (rows.groupBy("sha").agg(F.min(F.struct("id", "n", "prefix", "bitmap")).alias("r"))
             .select(F.col("r.id").alias("node"), "r.n", "r.prefix", "r.bitmap"))
    nodes = saved(nodes, "nodes")
    discard(many)

    prefixes = nodes.select("node", "n", "prefix")
    shape = f"token bigint, node {kind}, n bigint"
    shared = saved(map_arrow(prefixes, shape, _exploded(None)).groupBy("token").agg(F.count("*").alias("m")).where("m > 1"), "shared")
    known = spark.sparkContext.broadcast(bloom.build(shared, "token", bloom.bits_for(shared.count(), 16)))
    member = saved(map_arrow(prefixes, shape, _exploded(known)).join(shared, "token").select("token", "m", "node"), "members")
    discard(shared)
    small = (member.where(F.col("m") <= MANY).groupBy("token").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
             .groupBy("nodes").agg(F.min("token").alias("cell")))
    cells = saved(small.select("cell", F.explode("nodes").alias("node"))
                  .unionByName(member.where(F.col("m") > MANY).select(F.col("token").alias("cell"), "node")), "cell")
    discard(member)
    return nodes, cells


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Two tables. ``documents``: id, n (set size), class_id (smallest id of an
    equal set), component_id (smallest id of the component), component and key
    (the component's and the row's own key: an id with several texts may be in
    several components), one row per row of ``docs``. ``links``: a, b,
    shared, either (intersection and union) of the verified links between
    classes that join the components, not of all (``class_links`` has those).
    Ids are integers."""
    kind = "bigint"
    own = keyed(docs, doc_id, text)
    sizes = saved(map_arrow(own, f"id bigint, n bigint, sha binary, {field(own, 'doc')}", _scan(shingle)), "sizes")

    own = own.select("id", "text")
    nodes, cells = node_cells(own, kind, shingle, percent)
    in_cells = cells.groupBy("node").agg(F.count("*").alias("degree"))
    pivots = cells.join(in_cells, "node").groupBy("cell").agg(F.max_by("node", F.struct("degree", -F.col("node"))).alias("pivot"))

    bits = nodes.select("node", "n", "bitmap")
    a, b = (bits.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bitmap").alias(f"b{x}")) for x in "ab")
    spokes = saved(cells.join(pivots, "cell").where(F.col("pivot") != F.col("node"))
                  .select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    stars = (spokes.join(among(a, "a", spokes.select("a")), "a").join(among(b, "b", spokes.select("b")), "b")
             .select("a", "na", "ba", "b", "nb", "bb"))
    pairs = saved(map_arrow(stars, f"a {kind}, b {kind}", _allowed(percent)), "pairs")
    discard(spokes)
    links = checked_pairs(pairs, own, kind, shingle, percent)
    tested = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    active, reach = cells.select("cell", "node"), saved(components(links), "components")
    for most in ROUNDS:
        found = residual_pairs(active, reach, bits, kind, percent, most)
        pairs = saved(found.where("cell IS NULL").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            new = checked_pairs(pairs, own, kind, shingle, percent)
            tested, links = tested.unionByName(pairs), links.unionByName(new)
            if not new.isEmpty():
                reach = saved(components(links), "components")
        more = found.where("cell IS NOT NULL").select("cell").distinct()
        if more.isEmpty():
            break
        active = saved(active.join(more, "cell", "left_semi"), "active")
    discard(nodes, cells)
    classes = class_names(sizes)
    # a component is named by its smallest id
    smallest = reach.join(classes, "node").groupBy("component").agg(F.min("class_id").alias("component_id"))
    classes = classes.join(reach.join(smallest, "component"), "node", "left").select(
        "sha", "class_id", F.coalesce("component_id", "class_id").alias("component_id"), F.coalesce("component", "node").alias("component"))
    out = sizes.join(classes, "sha", "left").select(
        F.col("doc").alias("id"), "n", F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component_id")).alias("component_id"), F.col("id").alias("key"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component"))
    named = [F.when(F.col("key").isNotNull(), F.col(c)).alias(c) for c in ("class_id", "component_id", "component")]
    return out.select("id", "n", *named, "key"), named_links(links, class_names(sizes))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows by a key of id and text: ``id`` (the key; null for a null id),
    ``text``, ``doc`` (the id). Rows of one id with different texts are
    different nodes."""
    key = F.when(F.col(doc_id).isNotNull(), F.xxhash64(doc_id, text))
    return docs.select(key.alias("id"), F.col(text).alias("text"), F.col(doc_id).alias("doc"))


def class_names(sizes: DataFrame) -> DataFrame:
    """sha, node, class_id (smallest id) of each class of equal sets."""
    return sizes.where("n > 0 AND id IS NOT NULL").groupBy("sha").agg(F.min("id").alias("node"), F.min("doc").alias("class_id"))


def named_links(links: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between nodes as links between class ids, the smaller one first."""
    ends = [classes.select(F.col("node").alias(x), F.col("class_id").alias(f"id_{x}")) for x in "ab"]
    return links.join(ends[0], "a").join(ends[1], "b").select(
        F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), "shared", "either")


def class_links(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """a, b, shared, either (intersection and union) of all links between
    classes, a < b, each once: the full join. Copies are not expanded; classes
    and members are in ``documents`` of ``near_duplicates``."""
    kind = "bigint"
    own = keyed(docs, doc_id, text)
    sizes = saved(map_arrow(own, f"id bigint, n bigint, sha binary, {field(own, 'doc')}", _scan(shingle)), "sizes")
    own = own.select("id", "text")
    nodes, cells = node_cells(own, kind, shingle, percent)
    alone = nodes.select("node", F.col("node").alias("component"))
    found = residual_pairs(cells, alone, nodes.select("node", "n", "bitmap"), kind, percent, None, LINK_CHUNK, LINK_MEMBERS)
    pairs = saved(found.where("cell IS NULL").select("a", "b").distinct(), "pairs")
    discard(nodes, cells, found)
    return named_links(checked_pairs(pairs, own, kind, shingle, percent), class_names(sizes))


def among(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in ``ids`` (one column, saved), and few
    others: a Bloom filter in front of a join, which keeps most rows that the
    join would drop out of its shuffle."""
    keys = ids.select(F.xxhash64(ids.columns[0]).alias("k"))
    sent = df.sparkSession.sparkContext.broadcast(bloom.build(keys, "k", bloom.bits_for(ids.count(), 16)))
    names = df.columns

    def pick(batch: pa.RecordBatch):
        at = np.flatnonzero(sent.value.has(batch.column(batch.num_columns - 1).to_numpy()))
        for s in range(0, len(at), 512):
            part = batch.take(pa.array(at[s:s + 512]))
            yield {c: part.column(i) for i, c in enumerate(names)}

    return map_arrow(df.select("*", F.xxhash64(column)), ", ".join(field(df, c) for c in names), pick)


def checked_pairs(pairs: DataFrame, docs: DataFrame, kind: str, shingle: int, percent: int) -> DataFrame:
    """Links among ``pairs``, by the texts of their nodes."""
    ids = saved(pairs.select(F.col("a").alias("rid")).unionByName(pairs.select(F.col("b").alias("rid"))).distinct(), "ids")
    texts = among(docs.where(F.col("id").isNotNull()).select("id", "text"), "id", ids)
    texts = texts.join(ids, F.col("id") == F.col("rid"), "left_semi")
    links = saved(verified(pairs, texts, kind, shingle, percent), "links")
    discard(ids)
    return links


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of ``near_duplicates`` over whole ``documents``."""
    out, _ = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5_number_lower(array_to_string(words[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       coalesce(least(w.doc_id, c.c), w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT node, min(reach) AS c FROM r GROUP BY node) c ON c.node = w.doc_id
"""
