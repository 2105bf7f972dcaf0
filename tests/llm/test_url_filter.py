import random

import numpy as np

from strata.llm import bloom, url_filter as U


def model(url, rules, listed):
    head, sep, rest = (url or "").partition("://")
    host = path = ""
    if sep:
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[2:]
    return host, path, None, "block" if host in listed else "allow"


URLS = [None, "", "no scheme", "http://", "http:///x", "http://NET", "http://a.net", "http://a.net/", "HTTP://B.Example.NET/en/x?y#z",
        "http://example.net/en", "https://example.com/de/", "https://xexample.com/de/1", "https://x.example.com/de", "http://a.org/fr/1",
        "http://a.org/FR/1", "http://u@h:80/p", "http://bad.tv?x/y", "http://bad.tv", "http://sub.bad.tv/", "a://b://c.net/d", "http://é.net/ü\nz",
        "http://.net/", "http://net./x", "http://a..net/"]


def test_rules_equal_a_plain_model(spark):
    rows = [(i, u) for i, u in enumerate(URLS + URLS[6:9])] + [(None, "http://a.net/")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, host string")
    listed = spark.createDataFrame([("bad.tv",), ("é.net",), (None,)], "h string")
    got = sorted((tuple(r) for r in U.filter_urls(pages, U.RULES, listed).collect()), key=str)
    assert got == sorted(((i, *model(u, U.RULES, {"bad.tv"})) for i, u in rows), key=str)


def test_empty_lists_and_tables(spark):
    none = spark.createDataFrame([], "h string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in U.filter_urls(pages, (), none).collect()] == [(1, "a.net", "/", None, "allow")]
    assert U.filter_urls(pages.limit(0), U.RULES, none).count() == 0


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(U, "FIRST_BITS", 2)  # many false positives, so many levels
    monkeypatch.setattr(U, "NEXT_BITS", 2)
    r = random.Random(4)
    keys = [f"k{i}" for i in range(20_000)]
    listed = set(r.sample(keys, 3000)) | {"not in the universe"}
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    c = U.cascade(universe, spark.createDataFrame([(k,) for k in listed], "key string"))
    assert len(c.levels) > 2
    rows = universe.select("key", U.hashed("key", c.seed).alias("h")).collect()
    has = c.has(np.array([x["h"] for x in rows]))
    assert [k["key"] in listed for k in rows] == has.tolist()


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS k")
    f = bloom.build(keys, "k", bloom.bits_for(5000))
    assert f.has(np.array([r["k"] for r in keys.collect()])).all()
    other = np.array([r["k"] for r in spark.range(5000, 15000).selectExpr("xxhash64(id) AS k").collect()])
    assert f.has(other).mean() < 0.05
