"""Each stage against a plain version, on what the stage before has kept."""

import brute
import corpus_pipeline as C
import public_tokenizers
from conftest import SF_SMALL
from strata.llm.common import read, saved
from strata.llm.packing import BUDGET
from strata.llm.toxicity import THRESHOLD, toxicity_scores
from tokenizers import Tokenizer


def test_stages(spark):
    docs = read(spark, SF_SMALL, "documents")
    columns, kept = docs.columns, {}
    for name, stage in C.STAGES:
        before, docs = docs, saved(stage(spark, docs, SF_SMALL), f"test-{name}")
        kept[name] = (before.collect(), docs.collect())
        if name != "packing":
            assert docs.columns == columns and docs.schema == before.schema

    before, after = kept["toxicity"]
    scores = {r["id"]: r["score"] for r in toxicity_scores(read(spark, SF_SMALL, "documents"), read(spark, SF_SMALL, "labels")).collect()}
    assert sorted(after) == sorted(r for r in before if scores[r["doc_id"]] < THRESHOLD)

    before, after = kept["jaccard"]
    groups = brute.jaccard_components([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, _, c in groups if i == c)
    assert set(after) <= set(before)

    before, after = kept["passages"]
    rows = {r["doc_id"]: r for r in after}
    plain = brute.kept_words([(r["doc_id"], r["text"]) for r in before])
    assert len(rows) == len(before)
    for r, (i, words, left) in zip(before, plain):
        assert rows[i]["text"] == (r["text"] if len(words) == len(left) else " ".join(left))
        assert rows[i]["n_chars"] == (len(rows[i]["text"]) if len(words) > len(left) else r["n_chars"])

    before, after = kept["benchmark"]
    items = [(r["item_id"], r["text"]) for r in read(spark, SF_SMALL, "benchmark").collect()]
    rows = {r["doc_id"]: r["text"] for r in after}
    hits = brute.benchmark_hits([(r["doc_id"], r["text"]) for r in before], items)
    assert len(rows) == len(before) and any(h for _, _, h, _ in hits)
    for r, (i, words, hit, _) in zip(before, hits):
        if not hit:
            assert rows[i] == r["text"]
        else:
            left = brute.ALNUM.findall(rows[i].translate(brute.LOWER))
            assert "".join(left) == "".join(w for p, w in enumerate(words) if p not in hit)

    before, after = kept["packing"]
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    tokens = [(r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in before]
    assert sorted((r["doc_id"], r["n_tokens"]) for r in after) == sorted(tokens)
    full = {}
    for r in after:
        full.setdefault((r["bucket"], r["batch"]), []).append(r["bucket_len"])
    assert all(sum(x) <= BUDGET or len(x) == 1 for x in full.values())


def test_run_returns_the_last_stage(spark):
    assert C.run(spark, SF_SMALL).columns == ["doc_id", "n_tokens", "bucket", "bucket_len", "batch", "slot"]


def test_no_text_is_lost_with_a_repeated_id(spark):
    base = {x: " ".join(f"{x}{n}" for n in range(60)) for x in "ab"}
    rows = [(1, base["a"]), (2, base["a"] + " more"), (2, base["b"]), (3, base["b"]), (3, base["b"]), (None, base["a"]), (4, ""), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, key string")
    got = C.jaccard(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in got.collect()), key=str)
    assert kept == sorted([(False, 1, base["a"]), (False, 2, base["b"]), (True, 0, base["a"]), (False, 4, ""), (False, 5, None)], key=str)


def test_stages_read_short_arrow_batches(spark):
    """A task holds a few MB of texts at a time, not 10,000 of them."""
    import pyarrow as pa

    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    docs = spark.range(2_000, numPartitions=1).selectExpr("id AS doc_id", "repeat('some words ', 1000) AS text")
    assert spark.conf.get(key, None) in (None, str(4 << 20))
    C.STAGES[-1][1](spark, docs.limit(3), SF_SMALL)
    assert spark.conf.get(key) == str(4 << 20)
    assert max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect()) < 5 << 20
    spark.conf.set(key, "1m")  # the session's own bound holds
    C.STAGES[-1][1](spark, docs.limit(3), SF_SMALL)
    assert spark.conf.get(key) == "1m"
    spark.conf.unset(key)
