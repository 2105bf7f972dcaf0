"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only the bag has a label. A sentence's score
is a logistic function of its words and their beginnings (for languages that
compound or inflect), and the sentences combine by noisy-or:
a document is toxic if any sentence is. The weights are fitted to document
labels through the noisy-or, so they learn which sentences offend, and the
scores then locate those sentences.

Training takes at most ``TRAIN_DOCS`` labelled documents, chosen by a hash of
their ids; their words' document frequencies pick at most ``WORDS`` features
by log-odds; what a document says of those words is all that the driver gets.
Every document is scored whole, in one pass.

Defined cases: null and empty texts have no sentences and get the base score;
without labels of both kinds there are no features and every score is the
share of toxic labels (0 without labels); repeated rows give repeated rows;
null ids get a score and are never trained on; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import field, map_arrow, others, read, saved
from strata.llm.labels import held_out, training_labels
from strata.llm.words import ALNUM_WORDS, WordTable, word_tables

TRAIN_DOCS, WORDS, LEAST_DOCS = 30_000, 1024, 4
#: bytes of a word's beginning that are features beside the word
BEGINNINGS = (4, 5, 6, 7, 8)
STEPS, RATE, DECAY = 300, 0.1, 2e-4
THRESHOLD = 0.3
_END = np.zeros(256, dtype=bool)
_END[list(b".!?\n\r")] = True


def feature_hashes(table: WordTable) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and beginnings, and the word that each is of."""
    begin, longer = table.prefixes(BEGINNINGS)
    k, word = np.nonzero(longer)
    return np.concatenate((table.hashes, begin[k, word])), np.concatenate((np.arange(len(table.hashes)), word))


def sentences(table: WordTable) -> np.ndarray:
    """Running sentence number of each word; texts never share one."""
    ends = np.cumsum(_END[table.data]) if len(table.data) else np.empty(0, dtype=np.int64)
    return (ends[table.start] if len(table.start) else np.empty(0, dtype=np.int64)) + table.doc()


class ToxicityModel:
    """Sorted word hashes with weights, a bias and a document's base rate."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, bias: float, base: float):
        self.words, self.weights, self.bias, self.base = words, weights, bias, base
        self.shift = np.uint64(64 - 18)
        self.table = np.zeros(1 << 18, dtype=bool)
        self.table[words >> self.shift] = True

    def known(self, table: WordTable) -> tuple[np.ndarray, np.ndarray]:
        """Words that have features, in order, and the feature numbers."""
        hashes, word = feature_hashes(table)
        at = np.flatnonzero(self.table[hashes >> self.shift])
        if not len(at) or not len(self.words):
            return at[:0], at[:0]
        f = np.minimum(np.searchsorted(self.words, hashes[at]), len(self.words) - 1)
        same = self.words[f] == hashes[at]
        at, f = word[at[same]], f[same]
        order = np.lexsort((f, at))
        return at[order], f[order]

    def sentence_scores(self, table: WordTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sentences with feature words: text number, sentence number, score."""
        at, f = self.known(table)
        if not len(at):
            return at, at, np.empty(0)
        sent, doc = sentences(table)[at], table.doc()[at]
        pairs = np.unique(np.stack((sent, f, doc)), axis=1)  # a word counts once a sentence
        edge = np.flatnonzero(np.concatenate(([True], pairs[0][1:] != pairs[0][:-1])))
        total = np.add.reduceat(self.weights[pairs[1]], edge)
        return pairs[2][edge], pairs[0][edge], 1 / (1 + np.exp(-(total + self.bias)))


def noisy_or(doc: np.ndarray, score: np.ndarray, n: int, base: float) -> np.ndarray:
    """1 - (1 - base) * product of (1 - score) over each document's sentences."""
    logs = np.zeros(n)
    np.add.at(logs, doc, np.log1p(-np.minimum(score, 1 - 1e-12)))
    return 1 - (1 - base) * np.exp(logs)


def word_counts(sample: DataFrame) -> DataFrame:
    """word, toxic, clean: documents of each kind that have the word."""

    def scan(batch: pa.RecordBatch):
        for a, b, table in word_tables(batch.column(0), ALNUM_WORDS, lower=True, limit=4 << 20):
            y = batch.column(1).to_numpy()[a:b]
            word, of = feature_hashes(table)
            doc = table.doc()[of]
            order = np.lexsort((word, doc))
            word, doc = word[order], doc[order]
            first = np.ones(len(word), dtype=bool)
            first[1:] = (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])
            words, inverse = np.unique(word[first], return_inverse=True)
            toxic = np.bincount(inverse, weights=y[doc[first]], minlength=len(words))
            yield {"word": words.view(np.int64), "toxic": toxic, "docs": np.bincount(inverse, minlength=len(words)).astype(float)}

    return (map_arrow(sample.select("text", "y"), "word bigint, toxic double, docs double", scan)
            .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs")))


def fit(sample: DataFrame, words: int = WORDS) -> ToxicityModel:
    """``sample``: text, y; at most ``TRAIN_DOCS`` rows."""
    none = np.empty(0, dtype=np.uint64)
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if n == 0 or toxic in (0.0, float(n)):
        return ToxicityModel(none, np.empty(0), 0.0, toxic / n if n else 0.0)
    odds = F.log((F.col("toxic") + 0.5) / (F.lit(toxic) + 1)) - F.log((F.col("docs") - F.col("toxic") + 0.5) / (F.lit(n - toxic) + 1))
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("docs") - F.col("toxic") + 0.5))
    picked = (word_counts(sample).where(F.col("toxic") >= LEAST_DOCS).select("word", odds.alias("odds"), (odds / spread).alias("z"))
              .where("z > 2").orderBy(F.desc("z"), "word").limit(words).toArrow())
    chosen = picked.column("word").to_numpy().view(np.uint64) if picked.num_rows else none
    order = np.argsort(chosen)
    chosen, start = chosen[order], picked.column("odds").to_numpy()[order]
    model = ToxicityModel(chosen, np.zeros(len(chosen)), 0.0, 1e-3)
    if not len(chosen):
        model.base = toxic / n
        return model
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def bags(batch: pa.RecordBatch):
        for a, b, table in word_tables(batch.column(0), ALNUM_WORDS, lower=True):
            y = batch.column(1).to_numpy()[a:b]
            at, f = sent.value.known(table)
            sentence, doc = sentences(table)[at], table.doc()[at]
            cut = np.searchsorted(at, table.bounds)
            yield {"y": y, "sentence": [sentence[s:e].tolist() for s, e in zip(cut[:-1], cut[1:])],
                   "word": [f[s:e].tolist() for s, e in zip(cut[:-1], cut[1:])]}

    got = map_arrow(sample.select("text", "y"), "y double, sentence array<bigint>, word array<int>", bags).toArrow()
    y = got.column("y").to_numpy()
    words_of = got.column("word").combine_chunks()
    size = np.diff(words_of.offsets.to_numpy())
    f = words_of.flatten().to_numpy()
    sentence = got.column("sentence").combine_chunks().flatten().to_numpy()
    doc = np.repeat(np.arange(len(y)), size)
    trained = _train(y, doc, sentence, f, start)
    return ToxicityModel(chosen, *trained)


def _train(y, doc, sentence, f, start: np.ndarray):
    """Weights, bias and base rate by gradient steps (Adam) on the mean
    log-loss of the noisy-or, from the words' own log-odds, with a small pull
    back to them."""
    width = len(start)
    pairs = np.unique(np.stack((doc, sentence, f)), axis=1)
    doc, f = pairs[0], pairs[2]
    new = np.ones(pairs.shape[1], dtype=bool)
    new[1:] = (pairs[0][1:] != pairs[0][:-1]) | (pairs[1][1:] != pairs[1][:-1])
    bag = np.cumsum(new) - 1
    owner = doc[new]
    n = len(y)
    theta = np.concatenate((start, [-5.0, -5.0]))  # weights, bias, logit of the base rate
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        score = np.bincount(bag, weights=theta[f], minlength=len(owner)) + theta[-2]
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        base = 1 / (1 + np.exp(-theta[-1]))
        logs = np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n) + np.log1p(-base)
        q = np.clip(1 - np.exp(logs), 1e-9, 1 - 1e-9)
        # d loss / d(-logs) is 1 - y / q; d(-log(1 - p)) / d score is p
        slope = 1 - y / q
        back = slope[owner] * p
        g = np.empty_like(theta)
        g[:width] = np.bincount(f, weights=back[bag], minlength=width) / n + DECAY * (theta[:width] - start)
        g[-2] = back.sum() / n
        g[-1] = (slope * base).sum() / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return theta[:width], float(theta[-2]), float(1 / (1 + np.exp(-theta[-1])))


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target: str = "toxic",
                    train_docs: int = TRAIN_DOCS, sentence_score: float = THRESHOLD, with_rest: bool = False) -> DataFrame:
    """id, score, offending (start, end, score of the sentences that score
    ``sentence_score`` or more, in characters) of each row of ``docs``, and if
    asked its text and its other columns as the struct ``rest``."""
    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = saved(training_labels(labels, target).orderBy(F.xxhash64("lid"), "lid").limit(train_docs), "labels")
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    sample = own.join(F.broadcast(chosen), F.col("id") == F.col("lid")).select("text", "y")  # at most train_docs small rows
    model = docs.sparkSession.sparkContext.broadcast(fit(saved(sample, "sample")))
    schema = f"id {kind}, score double, offending array<struct<start:int,`end`:int,score:double>>"
    if with_rest:
        rest = others(docs, doc_id, text)
        own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *([rest] if rest is not None else []))
        schema += "".join(f", {field(own, c)}" for c in own.columns[1:])

    def score(batch: pa.RecordBatch):
        fitted = model.value
        for a, b, table in word_tables(batch.column(1), ALNUM_WORDS, lower=True):
            doc, sentence, p = fitted.sentence_scores(table)
            total = noisy_or(doc, p, b - a, fitted.base)
            offending = [[] for _ in range(b - a)]
            hit = np.flatnonzero(p >= sentence_score)
            if len(hit):
                number = sentences(table)
                first = np.searchsorted(number, sentence[hit])
                last = np.searchsorted(number, sentence[hit], side="right") - 1
                for i, s, e in zip(hit.tolist(), table.start[first].tolist(), table.stop[last].tolist()):
                    lo = int(table.offsets[doc[i]])
                    start = len(table.data[lo:s].tobytes().decode())
                    offending[doc[i]].append({"start": start, "end": start + len(table.data[s:e].tobytes().decode()), "score": float(p[i])})
            yield {"id": batch.column(0).slice(a, b - a), "score": total, "offending": offending,
                   **({c: batch.column(i).slice(a, b - a) for i, c in enumerate(batch.schema.names) if i} if with_rest else {})}

    return map_arrow(own, schema, score)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's rows over whole ``documents``, with the offending
    sentences beside them."""
    out = toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")
