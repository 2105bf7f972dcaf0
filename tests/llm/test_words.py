import random

import numpy as np
import pyarrow as pa

import brute
from strata.llm.passages import spaced_tables
from strata.llm.words import ALNUM_WORDS, SPACE_WORDS, covered, runs, word_tables

ALPHABET = "ab AB1é ß\t\n-.ü漢\x0b🙂_"


def _texts(seed, n=200):
    r = random.Random(seed)
    out = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return out[:n // 2] + [None, "", " ", "a"] + out[n // 2:] + [None]


def test_words_equal_the_patterns_whatever_the_run_size():
    texts = _texts(1)
    for table, pattern in ((SPACE_WORDS, brute.SPACE), (ALNUM_WORDS, brute.ALNUM)):
        for limit in (1, 50, 1 << 20):
            got = []
            for a, b, t in word_tables(pa.array(texts), table, lower=True, limit=limit):
                got += [[w.decode() for w in t.words(t.bounds[d], t.bounds[d + 1])] for d in range(b - a)]
            assert got == [pattern.findall((x or "").translate(brute.LOWER)) for x in texts]


def test_equal_words_have_equal_hashes_and_others_differ():
    seen = {}
    for _, _, t in word_tables(pa.array(_texts(2)), SPACE_WORDS, limit=64):
        for w, h in zip(t.words(0, len(t.hashes)), t.hashes.tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_windows_and_prefixes():
    (_, _, t), = word_tables(pa.array(["abcd abcx abcd abcx abcd", "abcd abcx"]), SPACE_WORDS)
    w = t.windows(2)
    assert w[0] == w[2] == w[5] and w[0] != w[1]
    assert t.within(2).tolist() == [True] * 4 + [False, True]
    hashes, longer = t.prefixes((3, 4))
    assert len(set(hashes[0].tolist())) == 1 and longer[0].all() and not longer[1].any()


def test_single_spacing():
    texts = _texts(3)
    got = []
    for a, b, t in spaced_tables(pa.array(texts)):
        got += [t.data[t.offsets[d]:t.offsets[d + 1]].tobytes().decode() for d in range(b - a)]
    assert got == [" ".join(brute.SPACE.findall(x or "")) for x in texts]


def test_covered_and_runs():
    mask = covered(np.array([1, 2, 6]), 3, 8)
    assert mask.tolist() == [False, True, True, True, True, False, True, True]
    assert [x.tolist() for x in runs(mask)] == [[1, 6], [5, 8]]


def test_tables_of_the_driver_are_not_sent_with_functions():
    import pyarrow as pa
    from pyspark import cloudpickle
    from strata.llm.words import SPACE_WORDS, _powers, word_tables

    texts = pa.array(["some words", None, "more of them"])
    want = [t.hashes.tolist() for _, _, t in word_tables(texts, SPACE_WORDS)]
    assert _powers[0][0].nbytes >= 8 << 20  # the driver has them now
    sent = cloudpickle.dumps(lambda x: [t.hashes.tolist() for _, _, t in word_tables(x, SPACE_WORDS)])
    assert len(sent) < 1 << 20
    assert cloudpickle.loads(sent)(texts) == want
    assert _powers
