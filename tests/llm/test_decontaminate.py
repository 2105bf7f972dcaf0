import random

import brute
from strata.llm import decontaminate as D


def tables(spark, seed=2):
    r = random.Random(seed)
    word = lambda: r.choice(["Ab", "ab", "x1", "é", "Zz", "q", "ß9", "tt"]) + str(r.randrange(6))
    text = lambda n: [word() for _ in range(n)]
    items = [(i, r.choice([", ", " ", "-"]).join(text(r.randint(8, 25)))) for i in range(12)]
    items += [(12, "one"), (13, None), (14, " .,"), (3, "Other words of item three, so there"), (None, "an item that has no id but words 1 2 3 4 5"), (15, items[0][1])]
    docs = []
    for i in range(40):
        body = text(r.randint(0, 30))
        for _ in range(r.randint(0, 2)):
            w = brute.ALNUM.findall(r.choice(items[:12])[1])
            a = r.randint(0, 5)
            body += [x.upper() for x in w[a:a + r.randint(3, 20)]] + text(r.randint(0, 6))
        docs.append((i, r.choice([" ", "! ", "\n"]).join(body)))
    docs += [(50, None), (51, ""), (52, "one"), (53, "ONE two one"), docs[0], (None, items[1][1]), (54, "an item that has no id but words 1 2 3 4 5")]
    schema = "doc_id long, text string, items string"
    return (docs, items, spark.createDataFrame([(i, t, "x") for i, t in docs], schema),
            spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, n int"))


def test_hits_equal_brute_force_in_one_block_and_in_many(spark):
    docs, items, d, b = tables(spark)
    want = sorted(((i, len(w), len(h), names) for i, w, h, names in brute.benchmark_hits(docs, items)), key=str)
    for limit in (D.BLOCK_WINDOWS, 5):
        rows = D.benchmark_hits(d, b, block_windows=limit).collect()
        got = sorted(((r["id"], r["n_words"], sum(r["end"]) - sum(r["first"]), r["items"]) for r in rows), key=str)
        assert got == want


def test_removed_spans_and_documents(spark):
    docs, items, d, b = tables(spark)
    hits = brute.benchmark_hits(docs, items)
    out = D.decontaminate(d, b, with_rest=True)
    rows = {(r["doc_id"], r["n_hit"]): r["text"] for r in out.collect()}
    for (i, text), (_, w, hit, _) in zip(docs, hits):
        left = rows[(i, len(hit))]
        kept = brute.ALNUM.findall((left or "").translate(brute.LOWER))
        if not hit:
            assert left == text
        elif not set(range(len(w))) - hit:
            assert kept == []
        # a cut may bring two words together, so compare their letters
        assert "".join(kept) == "".join(x for p, x in enumerate(w) if p not in hit)
    clean = D.decontaminate(d, b, "drop_documents")
    assert sorted((r["doc_id"] for r in clean.collect()), key=str) == sorted((i for i, _, h, _ in hits if not h), key=str)


def test_empty_tables(spark):
    _, _, d, b = tables(spark)
    assert D.benchmark_hits(d.limit(0), b).count() == 0
    assert all(not r["items"] for r in D.benchmark_hits(d, b.limit(0)).collect())


def test_hits_and_cuts_need_one_worker_a_task(spark):
    """However many blocks: each Python step of a plan has a worker of its own."""
    _, _, d, b = tables(spark)
    for limit in (D.BLOCK_WINDOWS, 5):
        plan = D.decontaminate(d, b, n=5, block_windows=limit)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1
