import datetime as dt

from pyspark.sql import functions as F

from strata.functions import (bucket_glob, bucket_path, has_exact_fields, jvm_split, jvm_split_size,
                              kv_get, kv_map, rs_type_of, strip_nul_prefix)
from strata.operators.logs import EVENT_SPEC, PAGE_SPEC, parse_page_log, rejected_lines


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def _jvm_split_model(s, sep):
    # Java String.split(regex) for a literal separator
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_jvm_split_matches_java_rule(spark):
    import random
    rnd = random.Random(7)
    lines = ["".join(rnd.choice("ab|") for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    lines += ["", "||", "a||", "||a", "a||||", "|||", "a|||"]
    got = _one(spark, [(x,) for x in lines], "s string", jvm_split("s", r"\|\|"))
    assert got == [_jvm_split_model(x, "||") for x in lines]
    sizes = _one(spark, [(x,) for x in lines], "s string", jvm_split_size("s", r"\|\|"))
    for n in (1, 2, 3):
        ex = _one(spark, [(x,) for x in lines], "s string", has_exact_fields("s", r"\|\|", n))
        assert ex == [sz == n for sz in sizes]


def test_arity_trailing_and_inner_empty(spark):
    last_empty = "||".join(["x"] * 20 + [""])
    mid_empty = "||".join(["x"] * 10 + [""] + ["x"] * 10)
    got = _one(spark, [(last_empty,), (mid_empty,)], "s string", has_exact_fields("s", r"\|\|", 21))
    assert got == [False, True]


def test_strip_nul_prefix(spark):
    rows = [("x\0\0abc",), ("abc",), ("x\0abc\0",), ("\0",)]
    assert _one(spark, rows, "s string", strip_nul_prefix("s")) == ["abc", "abc", "abc", ""]


def test_kv_rules(spark):
    p = "bd=1&osv=a%20b&uid= u1 &uid=u2&bad&eId=x=y&&bat="
    df = spark.createDataFrame([(p,)], "p string")
    r = df.select(*[kv_get("p", k).alias(k) for k in ("bd", "osv", "uid", "eId", "bat", "zz")]).first()
    assert r.asDict() == {"bd": "1", "osv": "a", "uid": "u2", "eId": "x=y", "bat": "", "zz": None}
    m = df.select(kv_map("p").alias("m")).first().m
    assert m == {"bd": "1", "osv": "a", "uid": "u2", "eId": "x=y", "bat": ""}


def test_kv_java_trim_and_percent_before_equals(spark):
    df = spark.createDataFrame([("\tuid\t=\x01v1\x02&a%b=c",)], "p string")
    r = df.select(kv_get("p", "uid").alias("u"), kv_get("p", "a%b").alias("ab")).first()
    assert r.u == "v1" and r.ab == "c"


def test_page_id_and_page_parse(spark):
    fields = ["bin\0it"] + [f"f{i}" for i in range(1, 20)] + ["pId=home?a=1&st=5&bd=x&uid= 9 "]
    df = spark.createDataFrame([("||".join(fields),)], "value string")
    r = parse_page_log(df, dt.datetime(2024, 1, 2, 3, 4)).first()
    assert r.it == "bin\0it".split("\0")[-1] == "it"
    assert r.pid == "home?a=1" and r.st == "5" and r.bd == "x" and r.uid == "9"
    assert r.sid == "f18" and r.srcid == "f19" and r.l_date == "2024-01-02"
    assert list(parse_page_log(df, dt.datetime(2024, 1, 2)).columns) == list(PAGE_SPEC.columns) + ["l_date"]


def test_rejects_report_jvm_arity(spark):
    line = "||".join(["a"] * 14 + [""])
    r = rejected_lines(spark.createDataFrame([(line,)], "value string"), EVENT_SPEC).first()
    assert r.n_fields == 14


def test_bucket_path(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 2, 10),), (dt.datetime(2024, 1, 1, 10, 7, 0),),
            (dt.datetime(2024, 1, 1, 10, 59, 59),)]
    got = _one(spark, rows, "t timestamp_ntz", bucket_path("t"))
    assert got == ["2023-12-31/23-55", "2024-01-01/10-00", "2024-01-01/10-50"]
    assert bucket_glob("/d", "ev", dt.datetime(2024, 1, 1, 0, 2, 10)) == "/d/2023-12-31/23-55/ev.*"


def test_rs_type_mapping(spark):
    rows = [(1,), (2,), (4,), (3,), (0,), (None,)]
    assert _one(spark, rows, "r int", rs_type_of("r")) == [1, 2, 2, 3, 3, 3]


def test_area_code_arity(spark):
    rows = [("01-A",), ("01-A-",), ("01-A-P",), (None,)]
    assert _one(spark, rows, "a string", has_exact_fields("a", "-", 3)) == [False, False, True, False]


def test_single_char_separator_fast_path(spark):
    import random
    rnd = random.Random(11)
    lines = ["".join(rnd.choice("a-\n") for _ in range(rnd.randint(0, 9))) for _ in range(400)]
    lines += ["", "-", "a-b-c-\n", "a-b-c\n", "--c", "a--"]
    df = spark.createDataFrame([(x,) for x in lines], "s string")
    for n in (1, 2, 3, 4):
        got = [r[0] for r in df.select(has_exact_fields("s", "-", n)).collect()]
        assert got == [len(_jvm_split_model(x, "-")) == n for x in lines], n
    tabs = ["a\tb\t\t", "\t\t", "a\t\tb"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in tabs], "s string")
           .select(has_exact_fields("s", "\t", 2)).collect()]
    assert got == [len(_jvm_split_model(x, "\t")) == 2 for x in tabs]


def test_days_before_and_window(spark):
    from strata.functions import days_before, window_before
    got = _one(spark, [("2024-03-01",)], "d string", days_before("d", 1))
    assert got == ["2024-02-29"]
    assert window_before("2019-07-17", 1, 7) == ("2019-07-10", "2019-07-16")


def test_very_long_lines_do_not_break_regexes(spark):
    # JVM regex loops over alternations recurse per character; these must not
    long_lines = ["a" * 100000, "a|" * 40000, "a-" * 40000,
                  "||".join(["f"] * 14 + ["uid=" + "u" * 50000 + "&" + "k=v&" * 5000])]
    df = spark.createDataFrame([(x,) for x in long_lines], "value string")
    r = df.select(has_exact_fields("value", r"\|\|", 15).alias("a"), has_exact_fields("value", "-", 3).alias("b"),
                  kv_get(F.element_at(F.split("value", r"\|\|"), -1), "uid").alias("u")).collect()
    assert [x.a for x in r] == [False, False, False, True]
    assert [x.b for x in r] == [False, False, False, False]
    assert r[3].u == "u" * 50000


def test_jvm_split_size_single_char_fast_path(spark):
    import random
    rnd = random.Random(13)
    for sep, alphabet in (("-", "ab-"), (" ", "ab \t"), ("\t", "a\t ")):
        lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 10))) for _ in range(300)]
        lines += ["", sep, sep * 3, "a" + sep * 2, sep + "a"]
        got = _one(spark, [(x,) for x in lines], "s string", jvm_split_size("s", sep))
        assert got == [len(_jvm_split_model(x, sep)) for x in lines], sep


_JAVA_WS_CHARS = "".join(chr(i) for i in range(0x21))


def _kv_model(payload):
    """The payload rule as plain Python (last wins, '%' cut after '=', Java trim)."""
    out = {}
    for tok in payload.split("&"):
        if "=" not in tok:
            continue
        i = tok.index("=")
        out[tok[:i].strip(_JAVA_WS_CHARS)] = tok[i + 1:].split("%")[0].strip(_JAVA_WS_CHARS)
    return out


def test_kv_rules_against_python_model(spark):
    import random
    rnd = random.Random(17)
    alphabet = ["a", "b", "=", "&", "%", " ", "\t", "\x01", "ab"]
    payloads = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(400)]
    keys = ["a", "b", "ab", "", "ba", "a b"]
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    rows = df.select("p", kv_map("p").alias("m"),
                     *[kv_get("p", k).alias(f"k{i}") for i, k in enumerate(keys)]).collect()
    for r in rows:
        model = _kv_model(r.p)
        assert r.m == model, r.p
        for i, k in enumerate(keys):
            assert r[f"k{i}"] == model.get(k), (r.p, k)


def test_bucket_path_keeps_null_times_and_combines(spark):
    from strata.functions.clock import bucket_path
    rows = [("2024-02-01 00:02:10",), (None,), ("1969-12-31 23:58:01",)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    out = df.select(bucket_path("t").alias("a"), bucket_path("t", lag=0).alias("b")).collect()
    assert [tuple(r) for r in out] == [("2024-01-31/23-55", "2024-02-01/00-00"), (None, None), ("1969-12-31/23-50", "1969-12-31/23-55")]


def test_line_is_split_once_and_no_regex_per_key(spark):
    """The plan of a parser splits the line once and the payload once."""
    import datetime as dt
    from strata.operators.logs import parse_event_log
    df = spark.createDataFrame([("a||b",)], "value string")
    plan = parse_event_log(df, dt.datetime(2024, 1, 1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 1 and plan.count(", &, -1)") == 1 and "regexp" not in plan


def test_kv_map_agrees_with_kv_get(spark):
    payloads = ["a=1&b=2&a=3", "&&a", "", None, " a =x%y&\tb=\x01z", "=v&b==c", "a=&a", "b=1&" * 5000 + "a=2"]
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    for r in df.select("p", kv_map("p").alias("m"), *[kv_get("p", k).alias("k_" + k) for k in ("a", "b", "zz")]).collect():
        for k in ("a", "b", "zz"):
            assert r["k_" + k] == (None if r.m is None else r.m.get(k)), (r.p, k)
