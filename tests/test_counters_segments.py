
from conftest import SF_MID
from strata.operators import counters, segments
from strata.sources import bindings


def test_daily_reset_filter(spark):
    state = spark.createDataFrame([("a", 2, "2024-01-01"), ("b", 5, "2024-01-02")],
                                  "cid string, count int, p_date string")
    assert counters.load_counts(state, "2024-01-03").count() == 0          # earlier day: reset
    assert [r.cid for r in counters.load_counts(state, "2024-01-02").collect()] == ["b"]


def test_daily_reset_two_table_layout(spark):
    counts = spark.createDataFrame([("a", 2)], "cid string, count int")
    day = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "p_date string")
    empty_day = spark.createDataFrame([], "p_date string")
    assert counters.load_counts_with_day(counts, day, "2024-01-02").count() == 1
    assert counters.load_counts_with_day(counts, day, "2024-01-03").count() == 0
    assert counters.load_counts_with_day(counts, empty_day, "2024-01-02").count() == 0


def test_merge_and_exclude(spark):
    state = spark.createDataFrame([("a", 3), ("b", 1)], "cid string, count long")
    delta = spark.createDataFrame([("a", 1), ("c", 2), ("c", 1)], "cid string, n long")
    merged = {r.cid: r["count"] for r in counters.merge_counts(state, delta).collect()}
    assert merged == {"a": 4, "b": 1, "c": 3}
    intents = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "cid string, rid long")
    counts = spark.createDataFrame(list(merged.items()), "cid string, count long")
    kept = sorted(r.cid for r in counters.exclude_capped(intents, counts, cap=3).collect())
    assert kept == ["b", "z"]   # a has 4 > 3


RULES = [
    (1, "event_type='purchase' and value>60"),
    (2, "user_id in (select user_id from seg_test_facts where value>180)"),
    (3, "1=0"),
    (4, "event_type='view' or value>400"),
    (5, "value is null"),
]


def test_fused_counts_equal_per_rule_forms(spark):
    facts = bindings.user_facts(spark, SF_MID)
    facts.createOrReplaceTempView("seg_test_facts")
    fused = {r.id: (r.group_number, r.group_active_count) for r in
             segments.segment_counts(facts, RULES, start="2024-01-20", end="2024-01-28").collect()}
    for rid, sql in RULES:
        n = segments.rule_users(facts, sql).first().group_number
        a = segments.rule_active_users(facts, sql, "2024-01-20", "2024-01-28").first().group_active_count
        assert fused[rid] == (n, a), (rid, sql)
    assert fused[3] == (0, 0)


def test_rules_in_batches(spark):
    facts = bindings.user_facts(spark, SF_MID)
    facts.createOrReplaceTempView("seg_test_facts")
    one = segments.segment_counts(facts, RULES, start="2024-01-28", end="2024-01-28")
    two = segments.segment_counts(facts, RULES, start="2024-01-28", end="2024-01-28", rules_per_pass=2)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_active_rules_and_rewrite(spark):
    rules = spark.createDataFrame([
        (1, "g", "OLD_DW.t.x = 1", 1), (2, "daily visitors", "x=1", 1), (3, "g", "", 1),
        (4, "g", None, 1), (5, "g", "y=2", 0), (6, "g", "old_dw.t", 1)],
        "id int, group_name string, group_rule_sql string, status int")
    out = segments.normalize_rules(segments.active_rules(rules, ("daily visitors",)), {"OLD_DW": "dw"}).orderBy("id").collect()
    assert [(r.id, r.group_rule_sql) for r in out] == [(1, "dw.t.x = 1"), (6, "old_dw.t")]


def test_invalid_rule_reports_null_counts(spark):
    facts = bindings.user_facts(spark, SF_MID)
    facts.createOrReplaceTempView("seg_test_facts")
    rules = RULES[:2] + [(9, "no_such_column > 1"), (10, "value >")]
    out = {r.id: (r.group_number, r.group_active_count) for r in
           segments.segment_counts(facts, rules, start="2024-01-28", end="2024-01-28").collect()}
    assert out[9] == (None, None) and out[10] == (None, None)
    assert out[1][0] > 0 and out[2][0] > 0


def test_bad_rules_do_not_touch_good_ones(spark):
    facts = bindings.user_facts(spark, SF_MID)
    facts.createOrReplaceTempView("seg_test_facts")
    good = {r.id: tuple(r) for r in segments.segment_counts(facts, RULES[:2]).collect()}
    rules = RULES[:2] + [(20, "value"), (21, "count(*) > 1"), (22, "event_type > 5"), (23, "1/0 > 1"), (24, "cast(event_type as int) = 1")]
    out = {r.id: tuple(r) for r in segments.segment_counts(facts, rules).collect()}
    assert {i: out[i] for i in good} == good
    assert out[20][1] is None and "not a condition" in out[20][3]
    assert out[21][1] is None and out[21][3].startswith("invalid")
    assert [out[i][1:] for i in (22, 23, 24)] == [(0, 0, "ok")] * 3  # values that do not convert are null
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_merge_counts_adds_null_clients(spark):
    state = spark.createDataFrame([(None, 2), ("a", 1)], "cid string, count long")
    delta = spark.createDataFrame([(None, 1), ("b", 5)], "cid string, n long")
    from strata.operators import counters
    assert {tuple(r) for r in counters.merge_counts(state, delta).collect()} == {(None, 3), ("a", 1), ("b", 5)}
    capped = spark.createDataFrame([(None, 9)], "cid string, count long")
    rows = spark.createDataFrame([(None,), ("a",)], "cid string")
    assert [r.cid for r in counters.exclude_capped(rows, capped).collect()] == ["a"]
