import pytest

from strata.session import scratch_path
from strata.sinks import append_partitioned, export, replace_table, snapshot_table


def test_append_into_catalog_table_is_positional(spark):
    name = "strata_test_log"
    spark.sql(f"drop table if exists {name}")
    spark.sql(f"create table {name} (a string, b string, l_date string) using parquet partitioned by (l_date)")
    df = spark.createDataFrame([("2024-01-01", "B", "A")], "l_date string, b string, a string")
    append_partitioned(df, name)
    append_partitioned(df, name)
    rows = spark.table(name).collect()
    assert len(rows) == 2 and all((r.a, r.b, r.l_date) == ("A", "B", "2024-01-01") for r in rows)
    spark.sql(f"drop table {name}")


def test_append_to_path_adds_partitions(spark):
    path = scratch_path(spark, "t_append")
    a = spark.createDataFrame([("x", "2024-01-01")], "v string, l_date string")
    b = spark.createDataFrame([("y", "2024-01-02")], "v string, l_date string")
    append_partitioned(a, path)
    append_partitioned(b, path)
    got = sorted((r.v, str(r.l_date)) for r in spark.read.parquet(path).collect())
    assert got == [("x", "2024-01-01"), ("y", "2024-01-02")]


def test_snapshot_refuses_existing_and_replace_overwrites(spark):
    path = scratch_path(spark, "t_snap")
    df = spark.range(10)
    snapshot_table(df, path, files=3)
    assert len([f for f in spark.read.parquet(path).inputFiles()]) == 3
    with pytest.raises(Exception):
        snapshot_table(df, path)
    replace_table(spark.range(4), path, files=1)
    assert spark.read.parquet(path).count() == 4


def test_export_single_file_and_modes(spark):
    path = scratch_path(spark, "t_csv")
    export(spark.range(100), path, fmt="csv", files=1)
    assert len(spark.read.csv(path).inputFiles()) == 1
    with pytest.raises(Exception):
        export(spark.range(1), path, fmt="csv")
    export(spark.range(5), path, fmt="csv", mode="overwrite", files=None)
    assert spark.read.csv(path).count() == 5


def test_id_chunks_of_a_hot_key_and_a_null_key(spark):
    from strata.operators.misc import collect_id_chunks
    rows = [("hot", i) for i in range(250)] + [(None, 7), (None, 7), ("b", 3), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(7)
    got = {(r.k, r.chunk): (r.n, r.ids) for r in collect_id_chunks(df, "k", "v", 100).collect()}
    assert got == {("hot", 0): (100, list(range(100))), ("hot", 1): (100, list(range(100, 200))),
                   ("hot", 2): (50, list(range(200, 250))), (None, 0): (2, [7, 7]), ("b", 0): (1, [3])}
    assert collect_id_chunks(df.limit(0), "k", "v").collect() == []


def test_json_schema_is_inferred_once_and_stored(spark):
    from strata.session import scratch_path
    from strata.sources.logs import json_schema, read_json_inferred
    path, stored = scratch_path(spark, "t_json"), scratch_path(spark, "t_json_schema")
    lines = ['{"a": 1, "b": 1.5, "OBJECT<x": {"y": [1, 2.5]}, "n": null, "m": 1}', '{"a": 2, "b": 3e10, "m": "s"}', "no json", "5", ""]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    df = read_json_inferred(spark, path, stored)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert types == {"a": "bigint", "b": "double", "OBJECT<x": "struct<y:array<double>>", "n": "string", "m": "string"}
    assert sorted((r.a, r.b, r.m) for r in df.where("a is not null").collect()) == [(1, 1.5, "1"), (2, 3e10, "s")]
    spark.createDataFrame([('{"a": "text", "z": 1}',)], "value string").write.mode("append").text(path)
    assert read_json_inferred(spark, path, stored).schema == df.schema      # the stored one
    assert len(json_schema(spark.createDataFrame([], "value string"))) == 0
