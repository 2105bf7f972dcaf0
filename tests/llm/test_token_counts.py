import json
import random

import public_tokenizers
import pytest

from conftest import SF_SMALL
from strata.llm import token_counts as T
from strata.llm.common import BATCH

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def library(texts):
    from tokenizers import Tokenizer
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_equal_the_library(spark):
    r = random.Random(1)
    chars = "ab Z9 \n\t'é\x85\xa0 st漢字🙂²½…— \x1c_" 
    texts = ["".join(r.choice(chars) for _ in range(r.randint(0, 60))) for _ in range(300)]
    texts += [None, "", " ", "<|endoftext|>", "a <|endoftext|><|endoftext|> b", "x" * 20_000, "don't I'll we've", texts[0]]
    docs = spark.createDataFrame([(i % 290, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, token string")
    want = sorted((i % 290, len((t or "").encode()), n) for i, (t, n) in enumerate(zip(texts, library(texts))))
    for head in (T.HEAD, 3):
        got = sorted((r["id"], r["n_bytes"], r["n_tokens"]) for r in T.token_counts(docs, PATH, head=head).collect())
        assert got == want


def test_whole_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = T.op6_token_counts(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == dict(zip(docs, library(docs.values())))
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)


def test_empty_table_and_other_tokenizers(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.token_counts(docs, PATH).count() == 0
    with pytest.raises(ValueError):
        T.token_counts(docs, str(public_tokenizers.path("word_bpe_49k.json")))


@pytest.fixture
def unbound(spark):
    """The session without a bound of Arrow batches."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key, None)
    spark.conf.unset(key)
    yield key
    spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def test_workers_get_short_batches_and_an_arrow_head(spark, unbound, monkeypatch, tmp_path):
    """What a worker holds does not grow with rows (10,000 a batch) or with
    objects of the head."""
    seen, sent = str(tmp_path / "bytes"), []
    map_arrow = T.map_arrow

    def watched(df, schema, fn):
        def step(batch):
            with open(seen, "a") as f:
                f.write(f"{batch.nbytes}\n")
            yield from fn(batch)

        return map_arrow(df, schema, step)

    monkeypatch.setattr(T, "map_arrow", watched)
    cls = type(spark.sparkContext)
    monkeypatch.setattr(cls, "broadcast", lambda self, x, f=cls.broadcast: sent.append(x) or f(self, x))
    text = "some words of 1 text, " * 1000
    docs = spark.createDataFrame([(i, text + str(i)) for i in range(600)], "doc_id long, text string").coalesce(1)
    want = library([text + str(i) for i in range(600)])
    assert [r["n_tokens"] for r in sorted(T.token_counts(docs, PATH).collect())] == want
    with open(seen) as f:
        sizes = list(map(int, f))
    assert sum(sizes) > 24 << 20 and max(sizes) < 2 * BATCH
    assert sent and not any(isinstance(x, dict) for x in sent)


def test_a_session_keeps_its_own_bound_of_batches(spark, unbound):
    spark.conf.set(unbound, "1000000")
    T.token_counts(spark.createDataFrame([(1, "a")], "doc_id long, text string"), PATH)
    assert spark.conf.get(unbound) == "1000000"


def test_head_is_the_most_frequent_without_a_sort(spark):
    r = random.Random(3)
    freq = {f"t{i}": int(r.paretovariate(0.5)) for i in range(3000)} | {"x" * 65: 10**9}
    vocab = spark.createDataFrame([(t, n, len(t)) for t, n in freq.items()], "token string, freq long, pieces long")
    short = {t: n for t, n in freq.items() if len(t) <= T.HEAD_CHARS}
    for most in (0, 1, 100, 1000, 5000):
        top = T._head(vocab, most).to_pydict()
        head = set(top["token"])
        assert top["pieces"] == [len(t) for t in top["token"]] and len(head) == len(top["token"]) <= most
        rest = [n for t, n in short.items() if t not in head]
        assert not head or not rest or min(short[t] for t in head) > max(rest)
        ranked = sorted(short.values(), reverse=True)
        assert all(n <= 2 ** 0.126 * ranked[most] for n in rest)  # only the step that does not fit is left out


def test_special_strings_across_neighbouring_texts(spark, tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"] += [spec["added_tokens"][0] | {"id": 50257 + i, "content": x} for i, x in enumerate(("#@", "@!"))]
    path = tmp_path / "special.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    from tokenizers import Tokenizer
    texts = ["x#", "@!y", "#@", "@", "!@!", "a #@! b", "", "@!"]
    want = [len(e.ids) for e in Tokenizer.from_file(str(path)).encode_batch(texts, add_special_tokens=False)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert [r["n_tokens"] for r in sorted(T.token_counts(docs, str(path)).collect())] == want


def test_pieces_are_counted_on_bounded_bytes(monkeypatch):
    """Long pre-tokens too: encodings take many times their bytes."""
    import pyarrow as pa
    from strata.llm.bpe import AT_ONCE, Merges

    r = random.Random(4)
    tokens = ["".join(r.choices("abcdeXYZ", k=k)) for k in (100, 50, 3) for _ in range(AT_ONCE // 64)] + ["a" * (AT_ONCE + 1), "b"]
    own, merges, sizes = T.Splitter(T.checked(PATH)), Merges(T.checked(PATH)), []
    monkeypatch.setattr(own, "encoded", lambda x, f=own.encoded: sizes.append(sum(map(len, x)) if len(x) > 1 else 0) or f(x))
    monkeypatch.setattr(merges, "_merged", lambda x, n, f=merges._merged: sizes.append(len(x)) or f(x, n))
    assert merges.pieces(pa.array(tokens, pa.large_string()), own, 1 << 20).tolist() == library(tokens)
    assert len(sizes) > 4 and max(sizes) <= AT_ONCE
