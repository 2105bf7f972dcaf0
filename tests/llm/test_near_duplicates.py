import random

import numpy as np
import pytest

import brute
from strata.llm import near_duplicates as nd, signature_tree as st

VOCABULARY = [f"w{i}" for i in range(4000)]


def corpus(seed=7):
    r = random.Random(seed)
    text = lambda n: [r.choice(VOCABULARY) for _ in range(n)]
    rows, passage = [], text(30)
    for base in range(6):
        words = text(r.choice([30, 60, 200]))
        for _ in range(r.choice([2, 5])):  # near copies around the threshold
            copy = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 40))):
                copy[r.randrange(len(copy))] = r.choice(VOCABULARY)
            rows.append(copy)
    rows += [text(40) + passage + text(40) for _ in range(20)]
    rows += [text(n) for n in (1, 2, 4, 5, 6, 6)]
    rows += [rows[0]] * 3 + [["W1", "w2"], ["w1", "W2"]]
    out = [(i, "\n".join(w) if i % 3 else " ".join(w)) for i, w in enumerate(rows)]
    n = len(out)
    return out + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (None, " ".join(rows[0])), out[0]]


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, token string")
    out, links = nd.near_duplicates(docs, **options)
    return sorted(((r["id"], r["n"], r["component_id"]) for r in out.collect()), key=str), links


def test_components_equal_brute_force(spark):
    rows = corpus()
    got, _ = run(spark, rows)
    assert got == brute.jaccard_components(rows)


def test_many_near_copies_and_chunks(spark, monkeypatch):
    """A group over the hot bound, cells in several chunks, two groups whose
    sets overlap without linking."""
    monkeypatch.setattr(nd, "MANY", 6)
    monkeypatch.setattr(nd, "CHUNK", 8)
    monkeypatch.setattr(nd, "ROUNDS", (1, 2, None))
    r = random.Random(3)
    base = [r.choice(VOCABULARY) for _ in range(120)]
    other = base[:95] + [r.choice(VOCABULARY) for _ in range(25)]
    rows = []
    for words in (base, other):
        for _ in range(30):
            copy = list(words)
            copy[r.randrange(len(copy))] = r.choice(VOCABULARY)
            rows.append(" ".join(copy))
    rows = list(enumerate(rows))
    got, links = run(spark, rows)
    assert got == brute.jaccard_components(rows)
    sets = {i: brute.shingles(t) for i, t in rows}
    for link in links.collect():
        x, y = sets[link["a"]], sets[link["b"]]
        assert (link["shared"], link["either"]) == (len(x & y), len(x | y))
    assert links.count() < 60 * 20  # far from all pairs


def test_empty_table(spark):
    assert run(spark, [])[0] == []


def test_all_texts_empty(spark):
    assert run(spark, [(1, None), (2, "")])[0] == [(1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("seed", range(3))
def test_dual_traversal_prunes_no_possible_pair(seed):
    r = np.random.default_rng(seed)
    pool = r.integers(0, 1 << 62, 400).astype(np.uint64)
    sets = []
    for _ in range(150):
        base = r.choice(pool, r.integers(5, 60), replace=False) if not sets or r.random() < 0.3 else sets[r.integers(len(sets))]
        keep = base[r.random(len(base)) > 0.05]
        sets.append(np.unique(np.append(keep, r.choice(pool, 1))))
    labels = r.integers(0, 4, len(sets))
    side = ([st.bitmap(s) for s in sets], np.array([len(s) for s in sets]), labels)
    left, right, _ = st.candidates(side, side, 80)
    found = set(zip(left.tolist(), right.tolist()))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            both = len(np.intersect1d(x, y))
            assert st.max_overlap(side[0][i], len(x), side[0][j], len(y)) >= both
            if labels[i] != labels[j] and 100 * both >= 80 * (len(x) + len(y) - both):
                assert (i, j) in found
    assert len(found) < len(sets) ** 2 / 2


def test_prefix_is_long_enough():
    r = random.Random(1)
    for _ in range(300):
        x = {r.random() for _ in range(r.randint(1, 60))}
        y = {*r.sample(sorted(x), r.randint(0, len(x))), *(r.random() for _ in range(r.randint(0, 8)))}
        if y and 100 * len(x & y) >= 80 * len(x | y):
            px, py = (set(sorted(s)[:nd.prefix_length(len(s), 80)]) for s in (x, y))
            assert px & py


def all_links(rows, percent=80):
    """Links between classes by brute force: (smaller id, larger id): (shared, either)."""
    sets = {}
    for i, t in rows:
        if i is not None and brute.shingles(t):
            key = frozenset(brute.shingles(t))
            sets[key] = min(i, sets.get(key, i))
    nodes = sorted((i, x) for x, i in sets.items())
    return {(i, j): (len(x & y), len(x | y)) for a, (i, x) in enumerate(nodes) for j, y in nodes[a + 1:] if 100 * len(x & y) >= percent * len(x | y)}


def class_links(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, token string")
    got = nd.class_links(docs, **options).collect()
    out = {(r["a"], r["b"]): (r["shared"], r["either"]) for r in got}
    assert len(out) == len(got)
    return out


def test_class_links_are_all_links(spark, monkeypatch):
    """A group of near copies with different texts, in one chunk and in many."""
    r = random.Random(5)
    base = [r.choice(VOCABULARY) for _ in range(150)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(30)] + [(100 + i, t) for i, t in corpus() if i is not None]
    want = all_links(rows)
    assert len(want) > 30 * 29 // 2
    assert class_links(spark, rows) == want
    monkeypatch.setattr(nd, "MANY", 6)
    monkeypatch.setattr(nd, "LINK_CHUNK", 8)
    monkeypatch.setattr(nd, "LINK_MEMBERS", 16)
    assert class_links(spark, rows) == want
    assert class_links(spark, [(1, None), (2, "")]) == {}


def test_ids_with_two_texts_lose_no_link(spark):
    """40 ids with two texts each, and a near copy of each text."""
    r = random.Random(12)
    rows = []
    for i in range(40):
        for j in (0, 1):
            base = [r.choice(VOCABULARY) + str(r.randrange(99)) for _ in range(80)]
            rows += [(i, " ".join(base)), (1000 + 2 * i + j, " ".join([*base, "more"]))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, token string")
    want = sorted((i, 1000 + 2 * i + j) for i in range(40) for j in (0, 1))
    groups, links = nd.near_duplicates(docs)
    assert sorted((x["a"], x["b"]) for x in links.collect()) == want
    assert sorted((x["a"], x["b"]) for x in nd.class_links(docs).collect()) == want
    got = groups.collect()
    assert len(got) == 160 and len({x["component"] for x in got}) == 80
    assert all(x["component_id"] == (x["id"] if x["id"] < 1000 else (x["id"] - 1000) // 2) for x in got)


@pytest.mark.parametrize("percent", (20, 40, 50, 80))
def test_no_width_is_too_far(percent):
    """Subsets as small as the similarity allows, at all places of the widths."""
    r = np.random.default_rng(percent)
    sets = []
    for n in (33, 64, 65, 100, 128, 129, 257):
        whole = np.unique(r.integers(0, 1 << 62, n).astype(np.uint64))
        sets += [whole, np.sort(r.choice(whole, -(-n * percent // 100), replace=False))]
    side = ([st.bitmap(s) for s in sets], np.array([len(s) for s in sets]), np.arange(len(sets)))
    left, right, _ = st.candidates(side, side, percent)
    found = set(zip(left.tolist(), right.tolist()))
    assert {(i, i + 1) for i in range(0, len(sets), 2)} <= found
