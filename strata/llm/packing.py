"""Packing by optimal length buckets.

The histogram of lengths is counted over all documents. Dynamic programming
over it chooses the bucket boundaries that minimise the padding, as each
document is padded to its bucket's boundary. Inside a bucket documents are
dealt to batches of at most ``budget`` padded tokens.

Lengths over ``budget`` are not padded and not cut: such a document is a batch
of its own. So the histogram has at most ``budget`` + 1 bins, whatever the
number of documents. Places inside a bucket are counted in two steps, by
salted groups of bounded size and their offsets, so no task has a whole bucket.

The lengths are the caller's: ``token_lengths`` counts a tokenizer's tokens,
``word_lengths`` white-space words, of which a budget holds as many words.

Defined cases: null and empty texts have length 0 and are packed like others;
null lengths count as 0; repeated rows and null ids are packed one by one;
ties are broken by a hash of the id; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strata.llm.bpe import Merges, pretokens
from strata.llm.common import map_arrow, read, saved
from strata.llm.splitter import Splitter, checked
from strata.llm.words import SPACE_WORDS, text_runs, word_tables

BUCKETS, BUDGET, GROUP = 16, 32_768, 10_000
#: distinct pre-tokens that are encoded at once, and bytes of the texts that they are of
HEAD, RUN = 1 << 16, 4 << 20


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` boundaries, each one of the (ascending) lengths,
    that minimise the sum of (boundary - length) * count.

    With n and s the running sums of counts and tokens, buckets that end at
    place j cost b_j * n_j - s_j + min over i of (best_i + s_i - b_j * n_i):
    lines of falling slope asked at rising b_j, so a moving lower hull gives
    each layer in one pass."""
    m = len(lengths)
    n, s = [0], [0]
    for length, c in zip(lengths, counts):
        n.append(n[-1] + c)
        s.append(s[-1] + length * c)
    best = [0] + [None] * m
    back: list[list[int]] = []
    for _ in range(min(buckets, m)):
        hull: list[tuple[int, int, int]] = []  # slope, intercept, place
        head, row, came = 0, [0] + [None] * m, [0] * (m + 1)
        for j in range(1, m + 1):
            if best[j - 1] is not None:
                line = (-n[j - 1], best[j - 1] + s[j - 1], j - 1)
                while len(hull) - head > 1:
                    (a1, b1, _), (a2, b2, _) = hull[-2], hull[-1]
                    if (line[1] - b1) * (a1 - a2) <= (b2 - b1) * (a1 - line[0]):
                        hull.pop()
                    else:
                        break
                hull.append(line)
            if len(hull) > head:
                x = lengths[j - 1]
                while len(hull) - head > 1 and hull[head + 1][0] * x + hull[head + 1][1] <= hull[head][0] * x + hull[head][1]:
                    head += 1
                row[j] = x * n[j] - s[j] + hull[head][0] * x + hull[head][1]
                came[j] = hull[head][2]
        back.append(came)
        best = row
        if best[m] == 0:
            break
    out, j = [], m
    for came in reversed(back):
        if j == 0:
            break
        out.append(lengths[j - 1])
        j = came[j]
    return out[::-1]


def pack(docs: DataFrame, length: Column, *, doc_id: str = "doc_id", buckets: int = BUCKETS, budget: int = BUDGET,
         group: int = GROUP) -> DataFrame:
    """doc_id, n_tokens, bucket (null if over the budget), bucket_len, batch
    (a number of its bucket), slot, one row per row of ``docs``."""
    rows = saved(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(length.cast("long"), F.lit(0)).alias("n_tokens")), "lengths")
    histogram = sorted(map(tuple, rows.where(F.col("n_tokens") <= budget).groupBy("n_tokens").count().toLocalIterator()))
    edges = boundaries([x for x, _ in histogram], [c for _, c in histogram], buckets)
    total = np.bincount(np.searchsorted(edges, [x for x, _ in histogram]).astype(int), weights=[c for _, c in histogram],
                        minlength=len(edges)).astype(int).tolist() if histogram else []
    bucket, size, per_batch, salts = F.lit(None).cast("int"), F.col("n_tokens"), F.lit(1).cast("long"), F.lit(1)
    for i in reversed(range(len(edges))):
        inside = F.col("n_tokens") <= edges[i]
        bucket = F.when(inside, F.lit(i)).otherwise(bucket)
        size = F.when(inside, F.lit(edges[i]).cast("long")).otherwise(size)
        per_batch = F.when(inside, F.lit(budget // max(1, edges[i])).cast("long")).otherwise(per_batch)
        salts = F.when(inside, F.lit(max(1, -(-total[i] // group)))).otherwise(salts)
    over = F.lit(max(1, -(-rows.where(F.col("n_tokens") > budget).count() // group)))
    salts = F.when(bucket.isNull(), over).otherwise(salts)
    keyed = rows.select("*", bucket.alias("bucket"), size.alias("bucket_len"), per_batch.alias("per_batch"),
                        F.pmod(F.xxhash64("doc_id", "n_tokens"), salts).alias("salt"))
    parts = saved(keyed.groupBy("bucket", "salt").agg(F.count("*").alias("n")), "parts")
    before = Window.partitionBy("bucket").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col("bucket").alias("b"), F.col("salt").alias("s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("bucket", "salt").orderBy(F.xxhash64("doc_id"), "doc_id", "n_tokens")
    placed = keyed.withColumn("row", F.row_number().over(own) - 1).join(
        offsets, F.col("bucket").eqNullSafe(F.col("b")) & (F.col("salt") == F.col("s")))
    place = F.col("offset") + F.col("row")
    return placed.select("doc_id", "n_tokens", "bucket", "bucket_len", F.floor(place / F.col("per_batch")).cast("long").alias("batch"),
                         (place % F.col("per_batch")).cast("long").alias("slot"))


def word_lengths(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words of each row of ``docs``."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def scan(batch: pa.RecordBatch):
        for a, b, table in word_tables(batch.column(1), SPACE_WORDS):
            yield {"doc_id": batch.column(0).slice(a, b - a), "n_words": np.diff(table.bounds)}

    return map_arrow(docs.select(doc_id, text), f"doc_id {kind}, n_words bigint", scan)


def token_lengths(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", most: int = HEAD) -> DataFrame:
    """doc_id, n_tokens of each row of ``docs`` by the tokenizer's file, as
    ``token_counts`` has them but in one pass without a shuffle: the distinct
    pre-tokens of each run of texts are encoded, ``most`` of them at once."""
    sc = docs.sparkSession.sparkContext
    body = sc.broadcast(checked(tokenizer))
    merges = sc.broadcast(Merges(body.value))
    kind = docs.schema[doc_id].dataType.simpleString()
    own: list[Splitter] = []

    def scan(batch: pa.RecordBatch):
        if not own:
            own.append(Splitter(body.value))
        for a, b, data, offsets in text_runs(batch.column(1), RUN):
            tokens, bounds, special = pretokens(data, offsets, own[0])
            distinct = tokens.dictionary_encode()
            pieces = merges.value.pieces(distinct.dictionary, own[0], most)
            total = np.concatenate(([0], np.cumsum(pieces[distinct.indices.to_numpy()])))
            yield {"doc_id": batch.column(0).slice(a, b - a), "n_tokens": total[bounds[1:]] - total[bounds[:-1]] + special}

    return map_arrow(docs.select(doc_id, text), f"doc_id {kind}, n_tokens bigint", scan)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of whole ``documents``, by their number of tokens."""
    import public_tokenizers

    return pack(token_lengths(read(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json"))), F.col("n_tokens"))
