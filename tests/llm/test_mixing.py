"""The mix against plain queues."""

import hashlib
import random
from fractions import Fraction

from strata.llm import mixing

SCHEMA = "doc_id long, text string, source string, row long, pos int, size string, key string"


def _words(text):
    return len([w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w])


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = Fraction(sum(sizes.values())), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        if not free:
            return names, weight, {s: Fraction(3 * sizes[s]) for s in names}
        share = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not above:
            return names, weight, {s: Fraction(3 * sizes[s]) if s in capped else weight[s] * share for s in names}
        capped |= above


def _plain(rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + _words(text)
    names, weight, target = _targets(sizes)
    entries = []
    for p, s in enumerate(names):
        queue = sorted((hashlib.md5(f"{'-' if i is None else i}:{t or ''}".encode()).hexdigest(), i if i is not None else -1, j, _words(t))
                       for j, (i, t, src) in enumerate(rows) if src == s)
        ahead = 0
        for key, _, j, size in queue:
            ahead += size
            entries += [((ahead + n * sizes[s]) / weight[s], p, key, j, n, size) for n in range(3)]
    left, taken = sum(sizes.values()), [0] * len(rows)
    for _, _, _, j, _, size in sorted(entries):
        if size > left:
            break
        left -= size
        taken[j] += size
    return sorted((i if i is not None else -1, _words(t), sizes[s], float(target[s]), taken[j]) for j, (i, t, s) in enumerate(rows))


def _check(spark, rows):
    df = spark.createDataFrame([(i, t, s, 1, 1, "x", "k") for i, t, s in rows], SCHEMA)
    got = mixing.mix(df).collect()
    mine = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["source_size"], r["target"], r["taken"]) for r in got)
    want = _plain(rows)
    assert [m[:3] + m[4:] for m in mine] == [w[:3] + w[4:] for w in want]
    assert all(abs(m[3] - w[3]) <= 1e-9 * max(1.0, w[3]) for m, w in zip(mine, want))
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    return got


def test_random_sources(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(0, 40), rng.choice(["a", "b", "c", "d", None, "é"])) for i in range(400)]
    got = _check(spark, rows)
    by = {}
    for r in got:
        t = by.setdefault((r["target"], r["source_size"]), [0, 0])
        t[0] += r["taken"]
        t[1] = max(t[1], r["size"])
    assert all(abs(target - taken) <= 2 * most for (target, _), (taken, most) in by.items())


def test_small_source_is_repeated_three_times(spark):
    rows = [(1, "one two", "a"), (2, "three", "a")] + [(i, "w " * 20, "b") for i in range(10, 60)]
    got = {r["doc_id"]: r for r in _check(spark, rows)}
    assert got[1]["target"] == 9 and got[1]["taken"] == 6 and got[2]["taken"] == 3


def test_nulls_repeats_and_long_texts(spark):
    rows = [(None, None, None), (None, "a b", None), (1, "", "x"), (2, "w " * 100_000, "x"), (3, "a\tb\nc", "y")] + [(7, "same text", "hot")] * 300
    _check(spark, rows)


def test_no_words_and_no_rows(spark):
    assert [r["taken"] for r in _check(spark, [(1, "", "a"), (2, None, "b")])] == [0, 0]
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_reruns_agree(spark):
    rows = spark.createDataFrame([(i, "w " * (i % 9), f"s{i % 4}", 1, 1, "", "") for i in range(200)], SCHEMA)
    first = sorted(map(tuple, mixing.mix(rows).collect()))
    assert first == sorted(map(tuple, mixing.mix(rows.repartition(7)).collect()))
