import random

import brute
from strata.llm import passages as P


def corpus(seed=5):
    r = random.Random(seed)
    word = lambda: f"v{r.randrange(900)}"
    text = lambda n: [word() for _ in range(n)]
    passage, long_ = text(60), text(130)
    rows = [text(r.randint(0, 90)) for _ in range(15)]
    rows += [text(20) + passage + text(r.randint(0, 40)) for _ in range(12)]
    rows += [text(5) + long_[r.randint(0, 60):] + text(9) for _ in range(8)]
    rows += [passage + text(3) + passage, ["a"] * 200, ["a"] * 60, ["a"] * 50, ["a"] * 49]
    near = text(150)
    for _ in range(6):
        copy = list(near)
        copy[r.randrange(150)] = word()
        rows.append(copy)
    rows += [rows[16], rows[16], rows[2], passage[:50], passage[:49]]
    order = list(range(len(rows)))
    r.shuffle(order)
    out = [(10 * i + 3, ("  \n" if i % 2 else " ").join(rows[j])) for i, j in enumerate(order)]
    return out + [(900, None), (901, ""), (902, " \t"), (None, " ".join(rows[16])), out[3], (5, "é ü " * 40), (6, " é  ü" * 45)]


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, sha int")
    return P.remove_repeats(docs, **options), docs


def expected(rows, window=50):
    return sorted(((i, len(w), len(w) - len(k), brute.sha(" ".join(k))) for i, w, k in brute.kept_words(rows, window)), key=str)


def test_equals_brute_force(spark):
    rows = corpus()
    for options in ({}, {"block_bytes": 2000}, {"window": 20, "phrase": 3}):
        out, _ = run(spark, rows, **options)
        got = sorted(((r["id"], r["n_words"], r["n_removed"], r["kept_sha"]) for r in out.collect()), key=str)
        assert got == expected(rows, options.get("window", 50))


def test_texts_that_lose_words(spark):
    rows = [r for r in corpus() if r[0] is not None]
    _, docs = run(spark, rows)
    out = P.without_repeats(docs)
    assert out.columns == docs.columns
    want = sorted((i, " ".join(k) if len(k) < len(w) else t) for (i, t), (_, w, k) in zip(rows, brute.kept_words(rows)) if t is not None)
    assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["text"] is not None) == want


def test_empty_table_and_no_repeats(spark):
    assert run(spark, [])[0].count() == 0
    rows = [(1, "a b c"), (2, "a b c")]
    assert {r["n_removed"] for r in run(spark, rows)[0].collect()} == {0}
