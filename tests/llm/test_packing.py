import random
from itertools import combinations

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from strata.llm import packing as P


def padding(lengths, counts, edges):
    return sum((min(e for e in edges if e >= x) - x) * c for x, c in zip(lengths, counts))


def test_boundaries_minimise_the_padding():
    r = random.Random(1)
    for _ in range(200):
        lengths = sorted(r.sample(range(0, 60), r.randint(1, 9)))
        counts = [r.randint(1, 9) for _ in lengths]
        k = r.randint(1, 5)
        got = P.boundaries(lengths, counts, k)
        assert len(got) <= k and got[-1] == lengths[-1] and set(got) <= set(lengths) and got == sorted(set(got))
        best = min(padding(lengths, counts, (*c, lengths[-1])) for n in range(min(k, len(lengths))) for c in combinations(lengths[:-1], n))
        assert padding(lengths, counts, got) == best
    assert P.boundaries([], [], 4) == []


def test_batches(spark):
    r = random.Random(2)
    rows = [(i, r.choice([0, 1, 5, 40, r.randint(1, 120)])) for i in range(500)] + [(None, 7), (3, 7), (3, 7), (600, None), (601, 999), (602, 999)]
    docs = spark.createDataFrame([(i, n, "x") for i, n in rows], "doc_id long, n int, bucket string")
    out = P.pack(docs, F.col("n"), buckets=5, budget=150, group=40).collect()
    assert sorted(((x["doc_id"], x["n_tokens"]) for x in out), key=str) == sorted(((i, n or 0) for i, n in rows), key=str)
    batches = {}
    for x in out:
        assert x["bucket_len"] >= x["n_tokens"]
        batches.setdefault((x["bucket"], x["batch"]), []).append(x)
    for (bucket, _), members in batches.items():
        assert sorted(x["slot"] for x in members) == list(range(len(members)))
        if bucket is None:
            assert len(members) == 1 and members[0]["n_tokens"] > 150
        else:
            assert len(members) * members[0]["bucket_len"] <= 150
    for bucket in {b for b, _ in batches}:  # all but one batch of a bucket are full
        sizes = sorted(len(m) for (b, _), m in batches.items() if b == bucket)
        assert len(set(sizes[1:])) <= 1
    assert len({x["bucket"] for x in out}) <= 6
    assert P.pack(docs.limit(0), F.col("n")).count() == 0


TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_lengths_equal_the_library(spark):
    texts = ["", None, "two words", "日本語のテキストは空白がない" * 9, "x" * 500, "QmFzZTY0" * 400, "a  b\n\n c's <|endoftext|> ü é", "two words"] * 2
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    library = Tokenizer.from_file(TOKENIZER)
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    for most in (P.HEAD, 1):
        assert [r["n_tokens"] for r in sorted(P.token_lengths(docs, TOKENIZER, most=most).collect())] == want


def test_batches_hold_the_budget_in_tokens(spark):
    library = Tokenizer.from_file(TOKENIZER)
    docs = {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids)
            for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    batches = {}
    for x in P.op8_packing(spark, SF_SMALL).collect():
        assert x["n_tokens"] == docs[x["doc_id"]] <= x["bucket_len"]
        batches.setdefault((x["bucket"], x["batch"]), []).append(x["bucket_len"])
    assert all(sum(b) <= P.BUDGET or len(b) == 1 for b in batches.values())
    assert sum(map(len, batches.values())) == len(docs)


def test_pretokens_and_pieces_equal_the_library(monkeypatch):
    """The splitter on bytes and the merges of many pre-tokens at once; the
    library gets long pre-tokens only, not those that one text alone has."""
    from strata.llm.bpe import LONG, Merges, pretokens
    from strata.llm.token_counts import Splitter, checked
    from strata.llm.words import text_runs
    import pyarrow as pa

    own, asked = Splitter(checked(TOKENIZER)), []
    merges, library = Merges(checked(TOKENIZER)), Tokenizer.from_file(TOKENIZER)
    monkeypatch.setattr(own, "encoded", lambda x, f=own.encoded: asked.extend(x) or f(x))
    r = random.Random(5)
    kinds = ["ab Z9 \n\t'", "'strevmld S", " \x85\xa0\t\r\n x'", "éÈßüɏ²½ªµ× a1'", "…—‘’“” a' ", "漢字🙂ʼ a", "\x00\x1c\x7f\xad_- a1", "abcdefghijklmnopqrstuvwxyzäöüéèñç '"]
    texts = ["".join(r.choice(r.choice(kinds[:k + 1]) if n % 3 else kinds[k]) for _ in range(r.randint(0, 120))) for n in range(400) for k in range(len(kinds))]
    texts += [None, "", " ", "'", "'s", "x's", " 's", "x'", "x'l", "x'll", "a'r", "  ", "a  ", "\xa0", "a\xa0\xa0b", "a \xa0b", "a\xa0 b", "x" * 500, " " * 300 + "y",
              "<|endoftext|>", "a <|endoftext|><|endoftext|> b", "<|endoftext|" * 3, "QmFzZTY0" * 30, "é" * 31 + "ab", "é" * 32 + "a"]
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    for limit, most in ((1 << 20, 1 << 16), (300, 7)):
        got = []
        for _, _, data, offsets in text_runs(pa.array(texts), limit):
            tokens, bounds, special = pretokens(data, offsets, own)
            total = [0]
            for x in merges.pieces(tokens, own, most).tolist():
                total.append(total[-1] + x)
            got += [total[b] - total[a] + n for a, b, n in zip(bounds[:-1], bounds[1:], special.tolist())]
        assert got == want
    assert asked and all(len(x.encode()) > LONG for x in asked)
