"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Inputs are the driver's test tables, or tables Spark derives from them
(``strata.sources.bindings``), so each query's work grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions.clock import bucket_path
from strata.functions.kv import with_values
from strata.operators import counters, logs, matching, misc, segments
from strata.session import read_table, scratch_path
from strata.sources import bindings

# Fixed run time of the checked ingest queries (l_date = 2024-02-01).
RUN_TS = dt.datetime(2024, 2, 1, 0, 2, 10)
RUN_DATE = "2024-02-01"

# Segment binding: facts = events; active window 2024-01-28 .. 2024-01-28.
ACTIVE_START = "2024-01-28"
ACTIVE_END = "2024-01-28"
FACTS_VIEW = "segment_facts"
SEGMENT_RULES = [
    (1, "event_type='purchase' and value>60"),
    (2, "value>150"),
    (3, "user_id % 7 = 0"),
    (4, f"user_id in (select user_id from {FACTS_VIEW} where value>180)"),
    (5, "1=0"),
]

# Invented names of the stored rules' binding.
SCHEMA_REWRITES = {"OLD_DW": "dw"}
EXCLUDED_GROUPS = ("daily visitors",)

# Counter binding: a client's stored counts are its orders per day.
COUNT_DAY = "1998-08-02"
MERGE_DAY = "1996-06-30"


def _houses(spark, sf):
    return matching.normalize_houses(bindings.houses(spark, sf))


def _intents(spark, sf):
    return matching.normalize_intents(bindings.intents(spark, sf))


# --- log ingest ----------------------------------------------------------------

def c2_event_log_parse(spark: SparkSession, sf: str) -> DataFrame:
    return logs.parse_event_log(bindings.event_lines(spark, sf), RUN_TS)


def c1_page_log_parse(spark: SparkSession, sf: str) -> DataFrame:
    return logs.parse_page_log(bindings.page_lines(spark, sf), RUN_TS)


def p2_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return logs.rejected_lines(bindings.event_lines(spark, sf), logs.EVENT_SPEC)


def p6_url_params(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "pages")
    q = F.regexp_extract("url", r"\?([^#]*)", 1)
    return with_values(p.select("page_id", q.alias("q")), "q", {"page": "page", "ref": "ref"}).drop("q")


def s2_bucket_path(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    return e.select("event_id", bucket_path("ts").alias("bucket"))


def p13_field_profile(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "documents").select(F.col("text").alias("value"))
    return logs.field_count_profile(d, " ")


def a8_max_struct(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "documents").select(F.col("text").alias("value"))
    return logs.max_line(d, " ")


# --- matching ----------------------------------------------------------------

def p9_normalize_intents(spark: SparkSession, sf: str) -> DataFrame:
    return _intents(spark, sf).select("rid", "cid", "city", "area", "place", "rs",
                                      "price_start", "price_end", "house_type")


def p14_price_band(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part")
    return p.where(F.col("p_retailprice").between(950.0, 960.0)).select("p_partkey", "p_retailprice")


def j1_place_candidates(spark: SparkSession, sf: str) -> DataFrame:
    c = matching.place_candidates(_houses(spark, sf), _intents(spark, sf))
    return c.select("share_id", "fh_id", "cid", "rid", "see_time")


def j2_match_candidates(spark: SparkSession, sf: str) -> DataFrame:
    c = matching.match_candidates(_houses(spark, sf), _intents(spark, sf))
    return c.select("share_id", "fh_id", "cid", "rid", "tier")


def t1_top_clients_per_house(spark: SparkSession, sf: str) -> DataFrame:
    """The top clients come from the pair summaries; only their rows are fetched."""
    h, i = _houses(spark, sf), _intents(spark, sf)
    return matching.pair_rows(matching.match_pairs(h, i), h, i).select("share_id", "fh_id", "cid", "rid")


def w2_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """The latest row of each pair, over the rows of its top clients."""
    h, i = _houses(spark, sf), _intents(spark, sf)
    rows = matching.pair_rows(matching.match_pairs(h, i), h, i)
    return matching.latest_intent_per_pair(rows).select("share_id", "fh_id", "cid", "rid", "see_time")


def c3_match_stateless(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: J1+J2+T1+W2 fused (pair summaries, one ranking)."""
    pairs = matching.match_pairs(_houses(spark, sf), _intents(spark, sf))
    return pairs.select("share_id", "fh_id", "cid", "rid", "see_time")


def j3_place_or_area(spark: SparkSession, sf: str) -> DataFrame:
    c = matching.place_or_area_candidates(_houses(spark, sf), _intents(spark, sf))
    return c.select("fh_id", "cid", "rid", "tier")


def c4_best_client(spark: SparkSession, sf: str) -> DataFrame:
    b = matching.best_client_per_house(_houses(spark, sf), _intents(spark, sf))
    return b.select("fh_id", "cid", "rid", "see_time")


# --- counters ----------------------------------------------------------------

def _count_state(spark, sf) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return (o.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("cid"),
                     F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("p_date"))
            .groupBy("cid", "p_date").agg(F.count(F.lit(1)).alias("count")))


def m1_daily_reset(spark: SparkSession, sf: str) -> DataFrame:
    return counters.load_counts(_count_state(spark, sf), COUNT_DAY)


def a6_merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The counters of all days up to a cut, merged with those after it."""
    per_day = _count_state(spark, sf)
    early = F.col("p_date") <= MERGE_DAY
    state = per_day.where(early).groupBy("cid").agg(F.sum("count").alias("count"))
    return counters.merge_counts(state, per_day.where(~early).select("cid", F.col("count").alias("n")))


def j4_exclude_capped(spark: SparkSession, sf: str) -> DataFrame:
    totals = _count_state(spark, sf).groupBy("cid").agg(F.sum("count").alias("count"))
    return counters.exclude_capped(_intents(spark, sf), totals, cap=3).select("rid", "cid")


# --- segments ----------------------------------------------------------------

def _facts(spark, sf) -> DataFrame:
    f = bindings.user_facts(spark, sf)
    f.createOrReplaceTempView(FACTS_VIEW)
    return f


def r1_segment_counts(spark: SparkSession, sf: str) -> DataFrame:
    return segments.segment_counts(_facts(spark, sf), SEGMENT_RULES,
                                   start=ACTIVE_START, end=ACTIVE_END)


def a3_rule_users(spark: SparkSession, sf: str) -> DataFrame:
    """A3 for all rules in one scan (the per-rule form is ``segments.rule_users``)."""
    return r1_segment_counts(spark, sf).select("id", "group_number")


def a4_rule_active(spark: SparkSession, sf: str) -> DataFrame:
    """A4 for all rules in one scan (the per-rule form is ``segments.rule_active_users``)."""
    return r1_segment_counts(spark, sf).select("id", "group_active_count")


def stored_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A rule table derived from ``events``: one stored rule per event type."""
    t = read_table(spark, sf, "events").select("event_type").distinct()
    et = F.col("event_type")
    return t.select(
        (F.ascii(et) * 100 + F.length(et)).cast("int").alias("id"),
        F.when(et == "view", F.lit(EXCLUDED_GROUPS[0])).otherwise(et).alias("group_name"),
        F.when(et == "error", F.lit("")).otherwise(F.concat(
            F.lit("event_type = '"), et,
            F.lit("' and uuid in (select uuid from OLD_DW_facts where value > 100)"))
        ).alias("group_rule_sql"),
        F.when(et == "signup", F.lit(0)).otherwise(F.lit(1)).alias("status"),
    )


def r2_active_rules(spark: SparkSession, sf: str) -> DataFrame:
    return segments.normalize_rules(segments.active_rules(stored_rules(spark, sf), EXCLUDED_GROUPS), SCHEMA_REWRITES)


def r1_stored_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    f = bindings.user_facts(spark, sf)
    f.createOrReplaceTempView("dw_facts")
    return segments.segment_counts(f, r2_active_rules(spark, sf), start=ACTIVE_START, end=ACTIVE_END)


def thousand_rules() -> list[tuple[int, str]]:
    """1,000 rules by thresholds and moduli."""
    kinds = ["value > {t}", "event_type = 'purchase' and value > {t}", "user_id % {m} = 0",
             "event_type in ('view', 'click') and user_id % {m} = 1"]
    return [(i, kinds[i % 4].format(t=i * 7 % 500, m=i % 97 + 2)) for i in range(1000)]


def r1_thousand_rules(spark: SparkSession, sf: str) -> DataFrame:
    """R1 with 1,000 rules in one scan."""
    counts = segments.segment_counts(_facts(spark, sf), thousand_rules(), start=ACTIVE_START, end=ACTIVE_END)
    return counts.select("id", "group_number", "group_active_count")


def r1_bad_rules(spark: SparkSession, sf: str) -> DataFrame:
    """R1 beside rules that are no conditions, do not resolve, or do not convert."""
    rules = SEGMENT_RULES[:2] + [(11, "value"), (12, "count(*) > 1"), (13, "event_type > 5"), (14, "no_such_column = 1"), (15, "value >")]
    counts = segments.segment_counts(_facts(spark, sf), rules, start=ACTIVE_START, end=ACTIVE_END)
    return counts.select("id", "group_number", "group_active_count", (F.col("status") == "ok").alias("counted"))


# --- small operators -----------------------------------------------------------

def a2_collect_ids(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    ids = misc.collect_ids(e, "user_id", "event_id")
    return ids.select("user_id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


def p15_fill(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "documents").select("doc_id")
    lab = read_table(spark, sf, "labels").select(
        "doc_id", "quality", "toxic", F.concat(F.lit("L"), F.col("doc_id").cast("string")).alias("label_ref"))
    return misc.fill_defaults(d.join(lab, "doc_id", "left"))


def a2_collect_all_ids(spark: SparkSession, sf: str) -> DataFrame:
    """A2 without the null filter: a key with only nulls gives an empty list."""
    e = read_table(spark, sf, "events")
    value = F.when(F.col("event_type") == "view", F.col("event_id"))
    ids = misc.collect_ids(e.select("user_id", value.alias("view_id")), "user_id", "view_id", drop_null=False)
    return ids.select("user_id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


def a2_id_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """A2 in chunks: few keys, each with a large share of all rows."""
    chunks = misc.collect_id_chunks(read_table(spark, sf, "events"), "event_type", "event_id", size=1000)
    return chunks.select("event_type", "chunk", "n", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


def a10_first_row(spark: SparkSession, sf: str) -> DataFrame:
    """A10: the first row, by an order that makes it stable."""
    e = read_table(spark, sf, "events")
    return e.orderBy(F.col("value").desc(), "event_id").limit(1).select("event_id", "user_id", "event_type")


def k8_preview(spark: SparkSession, sf: str) -> DataFrame:
    """K8: the first rows as ``show`` would print them, by a stable order."""
    return _intents(spark, sf).orderBy("rid").limit(20).select("rid", "cid", "area", "place")


def j6_intents_of_counted(spark: SparkSession, sf: str) -> DataFrame:
    """Intents restricted to counted clients by an inner join on ``cid``."""
    counted = _count_state(spark, sf).groupBy("cid").agg(F.sum("count").alias("count")).where(F.col("count") > 3)
    return _intents(spark, sf).join(counted, "cid").select("rid", "cid", "count")


def f11_days_before(spark: SparkSession, sf: str) -> DataFrame:
    """the day 7 days before each event's."""
    from strata.functions.clock import days_before
    f = bindings.user_facts(spark, sf)
    return f.select("event_id", days_before("l_date", 7).alias("day"))


def _facts_by_date(spark, sf) -> DataFrame:
    """The user facts as a table partitioned by ``l_date`` (K1)."""
    from strata.sinks.writers import append_partitioned
    path = scratch_path(spark, "facts_by_date")
    f = bindings.user_facts(spark, sf)
    append_partitioned(f, path, "l_date")
    return spark.read.schema(f.schema).parquet(path)


def s4_date_scan(spark: SparkSession, sf: str) -> DataFrame:
    return misc.date_partition_scan(_facts_by_date(spark, sf), "l_date", start="2024-01-28").select(
        "event_id", "uuid", "l_date", "event_type")


def _database(spark) -> str:
    """A fresh database in the shared folder."""
    path = scratch_path(spark, "db")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"create database {name} location '{path}'")
    return name


def s3_k1_catalog_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S3 + K1 + K2 + K3 on catalog tables: two appends into a partitioned table
    by position (``insertInto``), a pruned scan, a snapshot, then a replacement."""
    from strata.sinks.writers import append_partitioned, replace_table, snapshot_table
    db = _database(spark)
    f = bindings.user_facts(spark, sf).select("event_type", "event_id", "uuid", "value", "l_date")
    spark.sql(f"create table {db}.facts (event_id bigint, uuid bigint, event_type string, value double, l_date string) "
              "using parquet partitioned by (l_date)")
    append_partitioned(f.where("event_id % 2 = 0"), f"{db}.facts")
    append_partitioned(f.where("event_id % 2 = 1"), f"{db}.facts")
    recent = misc.date_partition_scan(spark.table(f"{db}.facts"), "l_date", start="2024-01-10")
    snapshot_table(recent, f"{db}.recent")
    totals = spark.table(f"{db}.recent").groupBy("l_date", "event_type").agg(F.count("*").alias("n"), F.count_distinct("uuid").alias("users"))
    replace_table(totals.limit(0), f"{db}.totals")
    replace_table(totals, f"{db}.totals")
    return spark.table(f"{db}.totals")


# --- ingest jobs, sinks and the stream (write, then read back) ------------------

def _write_bucket(spark, lines: DataFrame) -> str:
    """Lay rendered lines out as files in the run's 5-minute bucket."""
    from strata.functions.clock import bucket_folder
    prefix = scratch_path(spark, "logs")
    lines.write.mode("errorifexists").text(bucket_folder(prefix, RUN_TS))
    return prefix


def _read_back(spark, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def c2_ingest_event_log(spark: SparkSession, sf: str) -> DataFrame:
    """C2 end to end: bucket folder -> small-file scan -> parse -> partitioned append."""
    from strata.plans.ingest import ingest_event_log
    prefix = _write_bucket(spark, bindings.event_lines(spark, sf))
    target = scratch_path(spark, "event_log")
    parsed = ingest_event_log(spark, prefix, target, RUN_TS, file_pattern="part-*")
    return _read_back(spark, target, parsed)


def c1_ingest_page_log(spark: SparkSession, sf: str) -> DataFrame:
    from strata.plans.ingest import ingest_page_log
    prefix = _write_bucket(spark, bindings.page_lines(spark, sf))
    target = scratch_path(spark, "page_log")
    parsed = ingest_page_log(spark, prefix, target, RUN_TS, file_pattern="part-*")
    return _read_back(spark, target, parsed)


def c2_ingest_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """C2 by a ledger of buckets: three buckets, of which the first is ingested
    by two runs and the others by a late one; each line is there once."""
    from strata.plans.ingest import EVENT_FILE, ingest_pending, read_committed
    prefix, target, ledger = (scratch_path(spark, n) for n in ("logs", "event_log", "ledger"))
    lines = bindings.event_lines(spark, sf)
    for i, minute in enumerate(("00-05", "00-10", "00-40")):
        lines.where(F.pmod(F.crc32("value"), F.lit(3)) == i).write.text(f"{prefix}/2024-02-01/{minute}")
    for run_ts in (dt.datetime(2024, 2, 1, 0, 11), dt.datetime(2024, 2, 1, 0, 12), dt.datetime(2024, 2, 1, 1, 30)):
        ingest_pending(spark, prefix, EVENT_FILE, logs.EVENT_SPEC, target, ledger, run_ts, file_pattern="part-*")
    return read_committed(spark, target, ledger, logs.EVENT_SPEC).drop("bucket")


def l1_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """L1: the event parser on a file stream (availableNow), read back from the sink."""
    from strata.streaming.ingest import stream_log
    src = scratch_path(spark, "stream_src")
    bindings.event_lines(spark, sf).write.text(src)
    return _streamed(spark, sf, src, stream_log)


def l1_stream_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """L1 on the batch layout: files in date and time folders below the source."""
    from strata.streaming.ingest import stream_log
    return _streamed(spark, sf, _write_bucket(spark, bindings.event_lines(spark, sf)), stream_log)


def _streamed(spark, sf, src, stream_log) -> DataFrame:
    sink, ckpt = scratch_path(spark, "stream_sink"), scratch_path(spark, "stream_ckpt")
    q = stream_log(spark, src, sink, ckpt, logs.EVENT_SPEC, run_ts=RUN_TS,
                   trigger={"availableNow": True}, max_files_per_trigger=3)
    q.awaitTermination()
    like = logs.parse_event_log(bindings.event_lines(spark, sf), RUN_TS)  # schema only, not run
    return _read_back(spark, sink, like)


def k2_replace_table(spark: SparkSession, sf: str) -> DataFrame:
    """K2: a counter table replaced by the merged counters (second write wins)."""
    from strata.sinks.writers import replace_table
    path = scratch_path(spark, "counts")
    replace_table(m1_daily_reset(spark, sf), path)
    merged = a6_merge_counts(spark, sf)
    replace_table(merged, path)
    return spark.read.parquet(path).select("cid", "count")


def k3_snapshot_table(spark: SparkSession, sf: str) -> DataFrame:
    from strata.sinks.writers import snapshot_table
    path = scratch_path(spark, "snapshot")
    df = s4_date_scan(spark, sf)
    snapshot_table(df, path)
    return spark.read.parquet(path)


def k4_csv_export(spark: SparkSession, sf: str) -> DataFrame:
    from strata.sinks.writers import export
    path = scratch_path(spark, "csv")
    df = read_table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    export(df, path, fmt="csv", mode="errorifexists")
    return spark.read.schema(df.schema).csv(path)


def k6_json_export(spark: SparkSession, sf: str) -> DataFrame:
    """K6 + S6: null fill, JSON export, JSON read with a schema."""
    from strata.sinks.writers import export
    from strata.sources.logs import read_json
    path = scratch_path(spark, "json")
    df = p15_fill(spark, sf)
    export(df, path, fmt="json", mode="overwrite")
    return read_json(spark, path, schema=df.schema).select(*df.columns)


def s6_json_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """S6 without a given schema: JSON of events, inferred, stored, read twice."""
    from strata.sinks.writers import export
    from strata.sources.logs import read_json_inferred
    path, stored = scratch_path(spark, "json"), scratch_path(spark, "json_schema")
    e = read_table(spark, sf, "events")
    view = F.when(F.col("event_type") == "view", F.struct("user_id", F.array("event_id", "user_id").alias("ids")))
    export(e.select("event_id", "event_type", "value", view.alias("view")), path, fmt="json")
    read_json_inferred(spark, path, stored)
    j = read_json_inferred(spark, path, stored)
    return j.select("event_id", "event_type", "value", F.col("view.user_id").alias("viewer"), F.try_element_at("view.ids", F.lit(1)).alias("viewed"))


def _tsv_lines(spark, sf) -> DataFrame:
    """``events`` as tab-separated lines; every 4th ends in empty fields."""
    e = read_table(spark, sf, "events")
    base = [F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("event_type"),
            F.format_string("%.2f", "value"), F.date_format("ts", "yyyy-MM-dd")]
    pad = [F.concat(F.lit("c"), F.lit(str(i))) for i in range(6, 13)]
    last = F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.col("props"))
    return e.select(F.concat_ws("\t", *base, *pad, last).alias("value"))


def p13_tsv_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Field-count profile of tab-separated lines."""
    return logs.field_count_profile(_tsv_lines(spark, sf), "\t")


def k7_text_export(spark: SparkSession, sf: str) -> DataFrame:
    """P13 + K7: keep 13-field lines, save ``(line,13)`` tuples as text, read back."""
    from strata.sinks.writers import export
    path = scratch_path(spark, "text")
    kept = logs.lines_with_fields(_tsv_lines(spark, sf), "\t", 13)
    out = kept.select(F.concat(F.lit("("), "line", F.lit(","), F.col("n_fields").cast("string"),
                               F.lit(")")).alias("value"))
    export(out, path, fmt="text", mode="errorifexists")
    return spark.read.text(path).select(F.col("value").alias("record"))


# --- capped assignment -------------------------------------------------------------

def m2_assign_capped(spark: SparkSession, sf: str) -> DataFrame:
    """M2 with cap 3 on the matching binding."""
    from strata.operators.assignment import assign_capped
    picks, _, _ = assign_capped(_houses(spark, sf), _intents(spark, sf), k=3, cap=3)
    return picks.select("share_id", "fh_id", "cid", "rid", "n_rows")


def m2_assign_unbound_cap(spark: SparkSession, sf: str) -> DataFrame:
    """M2 with a cap no client can reach: must equal the stateless chain."""
    from strata.operators.assignment import assign_capped
    picks, _, _ = assign_capped(_houses(spark, sf), _intents(spark, sf), k=3, cap=1 << 40)
    return picks.select("share_id", "fh_id", "cid", "rid", "see_time")


def _match_state(spark, sf) -> DataFrame:
    """Counter state: a quarter of each client's orders, stamped for the run day (some over cap)."""
    o = read_table(spark, sf, "orders")
    return (o.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("cid"))
            .groupBy("cid").agg(F.expr("count(*) div 4").alias("count"))
            .withColumn("p_date", F.lit(COUNT_DAY)))


def c3_run_match(spark: SparkSession, sf: str) -> DataFrame:
    """C3 end to end: state load (M1), J4, M2, W2, then both tables replaced (K2)."""
    from strata.plans.match_job import run_match_job
    state_path, result_path = scratch_path(spark, "match_state"), scratch_path(spark, "match_result")
    replace_table_state = _match_state(spark, sf)
    replace_table_state.write.parquet(state_path)
    run_match_job(spark, bindings.houses(spark, sf), bindings.intents(spark, sf),
                  state_path, result_path, COUNT_DAY)
    return spark.read.parquet(result_path).select("share_id", "fh_id", "cid", "area_code", "price_start",
                                                  "price_end", "house_type")


def c3_run_match_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """C3 on catalog tables, with intents that have no row id (S3, K2)."""
    from strata.plans.match_job import run_match_job
    db = _database(spark)
    bindings.houses(spark, sf).write.saveAsTable(f"{db}.listings")
    bindings.intents(spark, sf).drop("rid").write.saveAsTable(f"{db}.intents")
    _match_state(spark, sf).write.saveAsTable(f"{db}.counts")
    run_match_job(spark, spark.table(f"{db}.listings"), spark.table(f"{db}.intents"), f"{db}.counts", f"{db}.result", COUNT_DAY)
    return spark.table(f"{db}.result").select("share_id", "fh_id", "cid")


# --- remaining small operators ------------------------------------------------

def p6_kv_map(spark: SparkSession, sf: str) -> DataFrame:
    """P6 as a whole map: event payloads to ``map<string,string>``, then look-ups."""
    from strata.functions.kv import kv_map
    from strata.functions.text import exact_fields
    fields = bindings.event_lines(spark, sf).select(F.explode(exact_fields("value", logs.SEP, 15)).alias("fields"))
    return (fields.select(kv_map(F.get("fields", 14)).alias("m"))
            .select(*[F.try_element_at("m", F.lit(k)).alias(c)
                      for c, k in (("uid", "uid"), ("eid", "eId"), ("obj", "obj"), ("bd", "bd"))]))


def t2_day_table_reset(spark: SparkSession, sf: str) -> DataFrame:
    """M1/T2, two-table layout: counters valid only when the stored day is the run day."""
    totals = _count_state(spark, sf).groupBy("cid").agg(F.sum("count").alias("count"))
    day = _count_state(spark, sf).select("p_date").distinct()
    return counters.load_counts_with_day(totals, day, "2001-08-01")


def r3_segment_export(spark: SparkSession, sf: str) -> DataFrame:
    """R3 through the segment job: stored rules -> R2 -> P18 -> R1 -> a CSV of strings."""
    from strata.plans.segment_job import run_segment_job
    path = scratch_path(spark, "segments_csv")
    facts = bindings.user_facts(spark, sf)
    facts.createOrReplaceTempView("dw_facts")
    out = run_segment_job(facts, stored_rules(spark, sf), ACTIVE_START, ACTIVE_END,
                          SCHEMA_REWRITES, EXCLUDED_GROUPS, target=path, fmt="csv")
    return spark.read.schema(out.schema).csv(path)


def c4_best_client_job(spark: SparkSession, sf: str) -> DataFrame:
    """C4 end to end: normalise, best client per listing, table replaced, read back."""
    from strata.plans.match_job import run_best_client_job
    path = scratch_path(spark, "best_client")
    run_best_client_job(bindings.houses(spark, sf), bindings.intents(spark, sf), path)
    return spark.read.parquet(path).select("fh_id", "cid", "rid", "see_time")


def k5_csv_parallel(spark: SparkSession, sf: str) -> DataFrame:
    """K5: CSV export at natural parallelism (one file per task), read back."""
    from strata.sinks.writers import export
    path = scratch_path(spark, "csv_parallel")
    df = s2_bucket_path(spark, sf)
    export(df, path, fmt="csv", mode="errorifexists")
    return spark.read.schema(df.schema).csv(path)
