"""Token counts by distinct pre-tokens.

A byte-level BPE tokenizer splits a text into pre-tokens and encodes each by
itself, so a text's count is the sum of its pre-tokens' counts. Pieces are
counted once for each distinct pre-token of the corpus; documents are joined
to those counts by their own pre-token frequencies. No ids are kept.

The join is split by frequency. The most frequent pre-tokens of at most
``HEAD_CHARS`` characters (a proven bound), at most ``HEAD`` of them, are
broadcast and summed where the document is read. The rest are joined through a
shuffle on the pre-token, where no key can be hot, as hot ones are in the head:
it is cut between steps of the frequency, an eighth of a power of two each, so
no table is sorted for it and a pre-token below it has at most a ``HEAD``-th of
all places, up to one step.

Texts are split and pieces merged by ``bpe``, on Arrow and numpy buffers of
bounded runs; workers hold the head as an Arrow array. Special strings inside
texts count as one token each, as the library does by default.

Defined cases: null and empty texts have no bytes and no tokens; repeated rows
give repeated rows; an empty table gives an empty table; other columns are not
read. Only tokenizers with a byte-level pre-tokenizer, without normaliser,
truncation, padding or prefix space, are taken; others raise ``ValueError``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.bpe import Merges, pretokens
from strata.llm.common import map_arrow, read, saved, short_batches
from strata.llm.splitter import Splitter, checked
from strata.llm.words import text_runs

HEAD = 1 << 17
HEAD_CHARS = 64
LIMIT = 1024
#: bytes of the texts that are split at once, and distinct pre-tokens merged at once
RUN, MOST = 4 << 20, 1 << 15


def vocabulary(docs: DataFrame, text: str, body, merges) -> DataFrame:
    """token, freq, pieces of each distinct pre-token."""
    own: list[Splitter] = []

    def splitter() -> Splitter:
        if not own:
            own.append(Splitter(body.value))
        return own[0]

    def scan(batch: pa.RecordBatch):
        for _, _, data, offsets in text_runs(batch.column(0), RUN):
            found = pretokens(data, offsets, splitter())[0].value_counts()
            yield {"token": found.field("values"), "freq": found.field("counts")}

    def count(batch: pa.RecordBatch):
        tokens = batch.column(0).cast(pa.large_string())
        yield {"token": tokens, "freq": batch.column(1), "pieces": merges.value.pieces(tokens, splitter(), MOST)}

    distinct = map_arrow(docs.select(text), "token string, freq bigint", scan).groupBy("token").agg(F.sum("freq").alias("freq"))
    return saved(map_arrow(distinct, "token string, freq bigint, pieces bigint", count), "pretokens")


def _head(vocab: DataFrame, most: int) -> pa.Table:
    """token, pieces of the most frequent pre-tokens: whole steps of the
    frequency, as many as hold at most ``most`` of them."""
    step = F.floor(F.log2("freq") * 8)
    short = vocab.where(F.length("token") <= HEAD_CHARS)
    least, n = None, 0
    for at, rows in sorted(map(tuple, short.groupBy(step).count().collect()), reverse=True):
        n += rows
        if n > most:
            break
        least = at
    return short.where(step >= F.lit(least)).select("token", "pieces").toArrow()


def token_counts(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """id, n_bytes, n_tokens of each row of ``docs``."""
    short_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    body = sc.broadcast(checked(tokenizer))
    vocab = vocabulary(docs, text, body, sc.broadcast(Merges(body.value)))
    top = _head(vocab, head)
    known = sc.broadcast((top.column("token").combine_chunks().cast(pa.large_string()), top.column("pieces").to_numpy()))
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"row bigint, id {kind}, n_bytes bigint, known bigint, tokens array<string>, counts array<bigint>"
    own: list[Splitter] = []

    def scan(batch: pa.RecordBatch):
        if not own:
            own.append(Splitter(body.value))
        frequent, pieces = known.value
        for a, b, data, offsets in text_runs(batch.column(2), RUN):
            tokens, bounds, special = pretokens(data, offsets, own[0])
            distinct = tokens.dictionary_encode()
            code, n = distinct.indices.to_numpy(), len(distinct.dictionary)
            at = pc.index_in(distinct.dictionary, value_set=frequent).fill_null(-1).to_numpy()
            value = np.append(pieces, 0)[at]
            total = np.concatenate(([0], np.cumsum(value[code])))
            rest = np.flatnonzero(at[code] < 0)
            of = np.searchsorted(bounds, rest, side="right") - 1
            pairs, times = np.unique(of * n + code[rest], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(b - a + 1) * n).astype(np.int32)
            part = batch.slice(a, b - a)
            yield {"row": part.column(0), "id": part.column(1), "n_bytes": np.diff(offsets),
                   "known": total[bounds[1:]] - total[bounds[:-1]] + special,
                   "tokens": pa.ListArray.from_arrays(ends, distinct.dictionary.take(pa.array(pairs % max(n, 1))).cast(pa.string())),
                   "counts": pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))}

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = saved(map_arrow(rows, schema, scan), "document_tokens")
    rest = (rows.select("row", F.explode(F.arrays_zip("tokens", "counts")).alias("t"))
            .select("row", F.col("t.tokens").alias("token"), F.col("t.counts").alias("c"))
            .join(vocab.select("token", "pieces"), "token")
            .groupBy("row").agg(F.sum(F.col("c") * F.col("pieces")).alias("more")))
    return (rows.select("row", "id", "n_bytes", "known").join(rest, "row", "left")
            .select("id", "n_bytes", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_tokens")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's rows over whole ``documents``."""
    import public_tokenizers

    out = token_counts(read(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
