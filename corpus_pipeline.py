"""Corpus pipeline: toxic documents go, near duplicates go, repeated passages
go, benchmark passages go, and what is left is packed into length buckets.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of ``documents``; ``n_chars`` is counted anew where a text
changes. The last returns each kept document's place in a batch.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import read, saved, short_batches
from strata.llm.decontaminate import decontaminate
from strata.llm.near_duplicates import near_duplicates
from strata.llm.packing import pack, token_lengths
from strata.llm.passages import without_repeats
from strata.llm.toxicity import THRESHOLD, toxicity_scores


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, from doc_id, text and the struct rest."""
    own = {c: F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c) for c in docs.columns}
    return df.select(*[v.alias(c) for c, v in own.items()])


def _recounted(df: DataFrame, changed) -> DataFrame:
    return df.withColumn("n_chars", F.when(changed, F.char_length("text").cast(df.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    scored = toxicity_scores(docs, read(spark, sf_dir, "labels"), with_rest=True)
    return _columns(scored.where(F.col("score") < THRESHOLD).withColumnRenamed("id", "doc_id"), docs)


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group; rows
    without an id are in no group. Of equal rows one stays."""
    groups, _ = near_duplicates(docs)
    kept = groups.where(F.col("component").isNotNull()).groupBy("component").agg(F.min(F.struct("id", "key")).alias("first"))
    kept = kept.select("first.*").distinct()
    same = (F.col("d.doc_id") == F.col("kept.id")) & (F.xxhash64("d.doc_id", "d.text") == F.col("kept.key"))
    return (docs.alias("d").join(kept.alias("kept"), same, "left_semi").dropDuplicates(["doc_id", "text"])
            .unionByName(docs.where(F.col("doc_id").isNull())))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that repeat."""
    out = without_repeats(docs)
    return _recounted(out, F.col("text").isNotNull() & (F.char_length("text") < F.col("n_chars")))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans that the benchmark also has."""
    out = decontaminate(docs, read(spark, sf_dir, "benchmark"), "remove_spans", with_rest=True)
    return _recounted(_columns(out, docs), F.char_length("text") < F.col("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's bucket, batch and slot by its number of tokens."""
    import public_tokenizers

    return pack(token_lengths(docs, str(public_tokenizers.path("byte_bpe_50k.json"))), F.col("n_tokens"))


def _staged(stage):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        short_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(f.__name__, _staged(f)) for f in (toxicity, jaccard, passages, benchmark, packing)]

#: the classifier of the first stage is beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written to the shared
    folder in between."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
