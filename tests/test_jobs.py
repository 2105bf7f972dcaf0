"""C3 job across runs: counters carry over within a day and reset the next day."""

from seq_model import sequential
from strata.operators import matching
from strata.plans.match_job import run_match_job
from strata.session import scratch_path
from test_assignment import H_SCHEMA, I_SCHEMA, _random_case


def _model_rows(spark, houses, intents, counts):
    h = matching.normalize_houses(spark.createDataFrame(houses, H_SCHEMA))
    i = matching.normalize_intents(spark.createDataFrame(intents, I_SCHEMA))
    picks, new_counts = sequential([r.asDict() for r in h.collect()], [r.asDict() for r in i.collect()],
                                   counts)
    return sorted((f, c) for _, f, c, _, _ in picks), new_counts


def test_counters_carry_within_a_day_and_reset_next_day(spark):
    houses, intents = _random_case(5, n_houses=10, n_intents=40, n_clients=5)
    h_df = spark.createDataFrame(houses, H_SCHEMA)
    i_df = spark.createDataFrame(intents, I_SCHEMA)
    state, result = scratch_path(spark, "t_state"), scratch_path(spark, "t_result")

    def run(day):
        run_match_job(spark, h_df, i_df, state, result, day)
        got = sorted((r.fh_id, r.cid) for r in spark.read.parquet(result).collect())
        counts = {r.cid: r["count"] for r in spark.read.parquet(state).collect()}
        days = {r.p_date for r in spark.read.parquet(state).collect()}
        return got, counts, days

    exp1, c1 = _model_rows(spark, houses, intents, None)
    got1, counts1, days1 = run("2024-03-01")
    assert got1 == exp1 and counts1 == c1 and days1 == {"2024-03-01"}

    exp2, c2 = _model_rows(spark, houses, intents, c1)          # same day: counters carry
    got2, counts2, _ = run("2024-03-01")
    assert got2 == exp2 and counts2 == c2
    assert got2 != got1                                          # capped clients were replaced

    got3, counts3, days3 = run("2024-03-02")                     # next day: reset
    assert got3 == exp1 and counts3 == c1 and days3 == {"2024-03-02"}


def test_match_job_on_catalog_tables(spark):
    from conftest import SF_SMALL
    from strata.sources import bindings
    spark.sql("create database if not exists strata_db")
    for t in ("listings", "intents", "counts", "result"):
        spark.sql(f"drop table if exists strata_db.{t}")
    bindings.houses(spark, SF_SMALL).write.saveAsTable("strata_db.listings")
    bindings.intents(spark, SF_SMALL).write.saveAsTable("strata_db.intents")
    sums = []
    for _ in range(2):   # the second run reads, then replaces, the counter table
        run_match_job(spark, spark.table("strata_db.listings"), spark.table("strata_db.intents"),
                      "strata_db.counts", "strata_db.result", "2024-03-01")
        sums.append(spark.table("strata_db.counts").agg({"count": "sum"}).first()[0])
    assert sums[1] > sums[0] > 0
    assert spark.table("strata_db.result").count() > 0


def test_segment_job_writes_string_counts(spark):
    from conftest import SF_SMALL
    from strata.plans.segment_job import run_segment_job
    from strata.sources import bindings
    facts = bindings.user_facts(spark, SF_SMALL)
    rules = spark.createDataFrame([
        (1, "buyers", "event_type = 'purchase'", 1),
        (2, "off", "value > 1", 0),
        (3, "daily visitors", "value > 1", 1),
        (4, "broken", "no_such_col = 1", 1),
        (5, "rewritten", "uuid in (select uuid from OLD_DW_t_facts)", 1)],
        "id int, group_name string, group_rule_sql string, status int")
    facts.createOrReplaceTempView("dw_t_facts")
    path = scratch_path(spark, "t_segjob")
    run_segment_job(facts, rules, "2024-01-01", "2024-01-31", {"OLD_DW": "dw"}, ("daily visitors",), target=path)
    out = {r.id: (r.group_number, r.group_active_count) for r in spark.read.parquet(path).collect()}
    assert set(out) == {"1", "4", "5"}                       # inactive and excluded rules dropped
    assert out["4"] == (None, None)                          # broken rule reported, not fatal
    n_users = facts.select("uuid").distinct().count()
    assert out["5"] == (str(n_users), str(n_users))          # schema name rewritten, view found
    assert int(out["1"][0]) > 0


def test_unreadable_state_raises_and_is_not_replaced(spark):
    import pytest
    houses, intents = _random_case(5)
    h_df, i_df = spark.createDataFrame(houses, H_SCHEMA), spark.createDataFrame(intents, I_SCHEMA)
    state, result = scratch_path(spark, "t_bad_state"), scratch_path(spark, "t_bad_result")
    spark.createDataFrame([("not a parquet table",)], "value string").write.text(state)
    before = spark.read.text(state).collect()
    with pytest.raises(Exception):
        run_match_job(spark, h_df, i_df, state, result, "2024-03-01")
    assert spark.read.text(state).collect() == before


def test_match_without_row_ids(spark):
    houses, intents = _random_case(3, n_houses=10, n_intents=40)
    i_df = spark.createDataFrame(intents, I_SCHEMA).drop("rid")
    i_df = i_df.unionByName(i_df.limit(5))  # equal rows
    numbered = i_df.collect()
    exp, counts = _model_rows(spark, houses, [(n, *r) for n, r in enumerate(numbered)], None)
    state, result = scratch_path(spark, "t_state"), scratch_path(spark, "t_result")
    run_match_job(spark, spark.createDataFrame(houses, H_SCHEMA), spark.createDataFrame(numbered, i_df.schema), state, result, "2024-03-01")
    assert sorted((r.fh_id, r.cid) for r in spark.read.parquet(result).collect()) == exp
    assert {r.cid: r["count"] for r in spark.read.parquet(state).collect()} == counts


def test_result_and_counters_are_one_commit(spark, monkeypatch):
    import pytest
    from pyspark.sql import DataFrameWriter
    from strata.plans.match_job import run_match_commit
    from strata.sinks.writers import read_committed_table
    houses, intents = _random_case(5, n_houses=8, n_intents=30, n_clients=5)
    h_df, i_df = spark.createDataFrame(houses, H_SCHEMA), spark.createDataFrame(intents, I_SCHEMA)
    root = scratch_path(spark, "t_commits")

    def tables():
        result, state = (read_committed_table(spark, root, t) for t in ("result", "state"))
        return sorted((r.fh_id, r.cid) for r in result.collect()), {r.cid: r["count"] for r in state.collect()}

    assert read_committed_table(spark, root, "state") is None
    run_match_commit(spark, h_df, i_df, root, "2024-03-01")
    exp1, c1 = _model_rows(spark, houses, intents, None)
    assert tables() == (exp1, c1)

    parquet = DataFrameWriter.parquet

    def failing(self, path, *a, **kw):
        if path.endswith("/state"):
            raise OSError("lost between the two writes")
        return parquet(self, path, *a, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(OSError):
        run_match_commit(spark, h_df, i_df, root, "2024-03-01")
    monkeypatch.undo()
    assert tables() == (exp1, c1)                                # neither table of the failed run shows

    run_match_commit(spark, h_df, i_df, root, "2024-03-01")
    assert tables() == _model_rows(spark, houses, intents, c1)   # the counters of the last complete run
