import datetime as dt

from conftest import SF_SMALL
from strata.operators import logs
from strata.plans import queries as Q
from strata.session import scratch_path
from strata.sources import bindings
from strata.streaming import stream_log


def test_batch_equals_stream(spark):
    lines = bindings.event_lines(spark, SF_SMALL)
    run_ts = dt.datetime(2024, 2, 1, 0, 2, 10)
    batch = logs.parse_event_log(lines, run_ts)
    src = scratch_path(spark, "t_stream_src")
    lines.repartition(5).write.text(src)
    sink, ck = scratch_path(spark, "t_sink"), scratch_path(spark, "t_ck")
    q = stream_log(spark, src, sink, ck, logs.EVENT_SPEC, run_ts=run_ts,
                   trigger={"availableNow": True}, max_files_per_trigger=2)
    q.awaitTermination()
    streamed = spark.read.schema(batch.schema).parquet(sink).select(*batch.columns)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    # restarting on the same checkpoint reads no file twice
    q2 = stream_log(spark, src, sink, ck, logs.EVENT_SPEC, run_ts=run_ts, trigger={"availableNow": True})
    q2.awaitTermination()
    assert spark.read.parquet(sink).count() == batch.count()


def test_ingest_job_appends_partition(spark):
    df = Q.c2_ingest_event_log(spark, SF_SMALL)
    assert df.select("l_date").distinct().collect()[0].l_date == Q.RUN_DATE
    assert df.count() == Q.c2_event_log_parse(spark, SF_SMALL).count()


def test_stream_into_catalog_table(spark):
    lines = bindings.event_lines(spark, SF_SMALL)
    src, ck = scratch_path(spark, "t_stream_src2"), scratch_path(spark, "t_ck2")
    lines.repartition(3).write.text(src)
    spark.sql("drop table if exists strata_stream_events")
    q = stream_log(spark, src, None, ck, logs.EVENT_SPEC, run_ts=dt.datetime(2024, 2, 1),
                   trigger={"availableNow": True}, sink_table="strata_stream_events")
    q.awaitTermination()
    assert spark.table("strata_stream_events").count() == logs.parse_event_log(lines, dt.datetime(2024, 2, 1)).count()
    spark.sql("drop table strata_stream_events")


def test_stream_reads_bucket_folders(spark):
    from strata.operators.logs import EVENT_SPEC
    from strata.session import scratch_path
    from strata.sources import bindings
    from strata.streaming.ingest import stream_log
    from strata.plans import queries as Q
    src, sink, ckpt = (scratch_path(spark, n) for n in ("t_src", "t_sink", "t_ckpt"))
    lines = bindings.event_lines(spark, "/root/testdata/sf0.001")
    lines.write.text(f"{src}/2024-02-01/00-00")
    q = stream_log(spark, src, sink, ckpt, EVENT_SPEC, run_ts=Q.RUN_TS, trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.read.parquet(sink).count() > 0


def _bucket_lines(n):
    return [("||".join([str(n)] + ["x"] * 13 + [f"uid={n}"]),)]


def test_ledger_catches_up_and_repeats_a_run_that_died(spark, monkeypatch):
    import pytest
    from strata.plans import ingest
    prefix, target, ledger = (scratch_path(spark, n) for n in ("t_led_logs", "t_led", "t_led_done"))
    for n, folder in enumerate(("2024-01-31/23-50", "2024-01-31/23-55", "2024-02-01/00-05")):
        spark.createDataFrame(_bucket_lines(n), "value string").coalesce(1).write.text(f"{prefix}/{folder}")

    def run(ts):
        return ingest.ingest_pending(spark, prefix, "event-log", logs.EVENT_SPEC, target, ledger, ts, file_pattern="part-*")

    def rows():
        got = ingest.read_committed(spark, target, ledger, logs.EVENT_SPEC).collect()
        return sorted((r.uid, r.l_date, r.bucket) for r in got)

    assert run(dt.datetime(2024, 1, 31, 23, 52)) == [] and rows() == []      # its bucket is still open
    first, second = ("0", "2024-01-31", "2024-01-31_23-50"), ("1", "2024-02-01", "2024-01-31_23-55")
    assert run(dt.datetime(2024, 1, 31, 23, 55)) == ["2024-01-31/23-50"] and rows() == [first]
    assert run(dt.datetime(2024, 1, 31, 23, 58)) == [] and rows() == [first]

    def died(*a, **kw):
        raise OSError("before the ledger's line")

    entries = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **kw: died() if data and isinstance(data[0], tuple)
                        and len(data[0]) == 2 else entries(data, *a, **kw))
    with pytest.raises(OSError):
        run(dt.datetime(2024, 2, 1, 0, 20))
    monkeypatch.undo()
    assert rows() == [first]                                                 # written, not committed
    assert run(dt.datetime(2024, 2, 2, 9, 0)) == ["2024-01-31/23-55", "2024-02-01/00-05"]
    assert rows() == [first, second, ("2", "2024-02-01", "2024-02-01_00-05")]  # days by bucket, not by run
