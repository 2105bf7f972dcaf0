"""URL filters by Bloom filter cascades.

A cascade holds a set of listed keys exactly, given the complete universe of
keys that will ever be asked. Level 1 encodes the listed keys; level 2 the
unlisted keys of the universe that pass level 1; level 3 the listed keys that
pass level 2; and so on, until a level has no false positives. The first level
that a key fails decides: an odd one says unlisted, an even one listed. A key
that passes all levels belongs to what the last level encodes.

Levels are bit arrays, built by aggregation over the distinct keys of the
corpus and broadcast; looking up takes no join. Their size follows the listed
keys, then the false positives, which shrink from level to level.

Rules are (host, path) prefixes with a verdict. The keys of a url are every
suffix of its host at a label (the host itself included) followed by every
prefix of its path as long as some rule's path. The longest listed key wins
(of equal length the one with the longer host); urls without one fall to the
listed hosts, a second cascade over whole hosts: block if listed, else allow.

Defined cases: null urls, urls without ``://`` and such without a host have
empty host, are in no list and are allowed; repeated rows give repeated rows;
empty tables and empty lists work; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import bloom
from strata.llm.common import map_arrow, read, saved

#: the contract's rules, and host labels that mark a listed host
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
LISTED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: bits a key of the first level, and of the others, which face fewer keys
FIRST_BITS, NEXT_BITS, HASHES = 12, 8, 4
#: largest level (128 MB); a larger list needs a join
MOST_BITS = 1 << 30


class Cascade:
    """Levels in order; ``has`` tests 64-bit key hashes."""

    def __init__(self, levels: list[bloom.Bloom], seed: int):
        self.levels, self.seed = levels, seed

    def has(self, keys: np.ndarray) -> np.ndarray:
        listed = np.full(len(keys), len(self.levels) % 2 == 1)
        left = np.arange(len(keys))
        for i, level in enumerate(self.levels):
            passed = level.has(keys[left])
            listed[left[~passed]] = i % 2 == 1
            left = left[passed]
        return listed


def hashed(key, seed: int):
    return F.xxhash64(F.lit(seed), key)


def cascade(universe: DataFrame, listed: DataFrame, column: str = "key") -> Cascade:
    """The cascade of ``listed`` keys over ``universe`` (string columns)."""
    both = (universe.select(column, F.lit(False).alias("listed")).unionByName(listed.select(column, F.lit(True).alias("listed")))
            .where(F.col(column).isNotNull()).groupBy(column).agg(F.max("listed").alias("listed")))
    both = saved(both, "keys")
    for seed in range(16):  # a seed under which no listed and unlisted key share a hash
        hashes = both.select(hashed(F.col(column), seed).alias("h"), "listed")
        clash = hashes.groupBy("h").agg(F.min("listed").alias("lo"), F.max("listed").alias("hi")).where("lo <> hi")
        if clash.isEmpty():
            break
    else:
        raise RuntimeError("key hashes clash under every seed")
    hashes = saved(hashes.distinct(), "hashes")
    levels: list[bloom.Bloom] = []
    encode, other = hashes.where("listed").select("h"), hashes.where("NOT listed").select("h")
    while True:
        n = encode.count()
        if n == 0 and levels:
            break
        per_key = NEXT_BITS if levels else FIRST_BITS
        bits = bloom.bits_for(n, per_key, MOST_BITS)
        if bits < n:
            raise ValueError("too many listed keys for a broadcast level")
        level = bloom.build(encode, "h", bits, HASHES, seed=len(levels))
        levels.append(level)
        sent = universe.sparkSession.sparkContext.broadcast(level)

        def passing(batch: pa.RecordBatch, sent=sent):
            keys = batch.column(0)
            yield {"h": keys.filter(pa.array(sent.value.has(keys.to_numpy())))}

        encode, other = saved(map_arrow(other, "h bigint", passing), "level"), encode
    return Cascade(levels, seed)


def split_url(url):
    """Host (A-Z lower-cased) and path of a url column."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, shape, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def url_keys(host, path, path_lengths):
    """Array of candidate rule keys, longest first, longer host first."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    hosts = F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), ".")))
    size = F.char_length(path)
    prefixes = F.array(*[F.when(size >= k, F.substring(path, 1, k)) for k in sorted(path_lengths, reverse=True)] or [F.lit(None).cast("string")])
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(
        F.filter(prefixes, lambda p: p.isNotNull()),
        lambda p: F.struct((-F.char_length(h) - F.char_length(p)).alias("n"), (-F.char_length(h)).alias("m"), F.concat(h, p).alias("key")))))
    return F.transform(F.array_sort(keys), lambda k: k["key"])


def filter_urls(pages: DataFrame, rules, listed_hosts: DataFrame, *, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of each row of ``pages``. ``rules``:
    (host, path, block or allow); ``listed_hosts``: one string column, hosts
    that are blocked where no rule fits."""
    spark = pages.sparkSession
    host, path = split_url(F.col(url))
    kind = pages.schema[page_id].dataType.simpleString()
    lengths = {len(p) for _, p, _ in rules}
    parts = pages.select(F.col(page_id).alias("id"), host.alias("host"), path.alias("path"))
    keyed = parts.withColumn("keys", url_keys(F.col("host"), F.col("path"), lengths))
    keys = keyed.select(F.explode("keys").alias("key")).distinct()
    filters = []
    for verdict in ("block", "allow"):
        own = [(h.translate(str.maketrans(UPPER, LOWER)) + p,) for h, p, v in rules if v == verdict]
        filters.append(cascade(keys, spark.createDataFrame(own, "key string")))
    name = listed_hosts.columns[0]
    filters.append(cascade(parts.select(F.col("host").alias("key")).where("key <> ''").distinct(),
                           listed_hosts.select(F.col(name).alias("key"))))
    sent = spark.sparkContext.broadcast(filters)
    block, allow, hosts = filters
    hashes = keyed.select("id", "host", "path", "keys",
                          F.transform("keys", lambda k: hashed(k, block.seed)).alias("block"),
                          F.transform("keys", lambda k: hashed(k, allow.seed)).alias("allow"),
                          hashed(F.col("host"), hosts.seed).alias("whole"))

    def judge(batch: pa.RecordBatch):
        blocks, allows, listed = sent.value
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        sizes = np.array([len(x) if x is not None else 0 for x in col["keys"]], dtype=np.int64)
        names = col["keys"].flatten()
        stop = blocks.has(col["block"].flatten().to_numpy())
        go = allows.has(col["allow"].flatten().to_numpy())
        bad = listed.has(col["whole"].to_numpy())
        row = np.repeat(np.arange(len(sizes)), sizes)
        at = np.flatnonzero(stop | go)
        rows, first = np.unique(row[at], return_index=True)
        rule, verdict = [None] * len(sizes), ["block" if b else "allow" for b in bad]
        for r, k in zip(rows.tolist(), at[first].tolist()):
            rule[r] = names[k].as_py()
            verdict[r] = "block" if stop[k] else "allow"
        yield {"page_id": col["id"], "host": col["host"], "path": col["path"], "rule": rule, "verdict": verdict}

    return map_arrow(hashes, f"page_id {kind}, host string, path string, rule string, verdict string", judge)


def hosts_with_labels(pages: DataFrame, labels, url: str = "url") -> DataFrame:
    """Distinct hosts of which some label is one of ``labels``."""
    host, _ = split_url(F.col(url))
    return (pages.select(host.alias("host")).distinct()
            .where(F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, labels)))))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's rows over whole ``pages``."""
    pages = read(spark, sf_dir, "pages")
    return filter_urls(pages, RULES, hosts_with_labels(pages, LISTED_LABELS))


OP9_SQL = r"""
WITH u AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', ['h', 'p']), {'h': '', 'p': ''}) AS x FROM pages),
s AS (SELECT page_id, translate(x.h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, x.p AS path FROM u),
r(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (SELECT s.page_id, max_by(struct_pack(rule := r.host || r.path, verdict := r.verdict), len(r.host || r.path) * 1000 + len(r.host)) AS m
      FROM s JOIN r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path) GROUP BY s.page_id)
SELECT s.page_id, s.host, s.path, f.m.rule AS rule,
       coalesce(f.m.verdict, CASE WHEN list_has_any(string_split(s.host, '.'),
         ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block' ELSE 'allow' END) AS verdict
FROM s LEFT JOIN f ON f.page_id = s.page_id
"""
