"""Text-log and JSON sources.

Many small log files are packed into few read tasks by Spark's file source
itself (``spark.sql.files.maxPartitionBytes`` / ``openCostInBytes``), which
is what a combine-input-format read did by hand.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from strata.session import target_exists


def read_log_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of one or many text files as DataFrame(``value string``); the
    file source's own packing decides the number of tasks."""
    return spark.read.text(path)


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """JSON lines; give a schema in production to skip the inference pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def json_schema(lines: DataFrame, col: str = "value") -> T.StructType:
    """The schema of JSON lines: one aggregation over the parsed lines, merged
    map-side. Whole numbers are longs, others doubles; a field with several
    kinds of values, or with nulls only, is a string. Lines that are no JSON
    object say nothing; without any, the schema is empty."""
    parsed = F.try_parse_json(col)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT<")
    text = lines.select(parsed.alias("v")).where(is_object).agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if not text.startswith("OBJECT<"):
        return T.StructType([])
    # quoted names stay as they are
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    ddl = "".join(x if x.startswith("`") else x.replace("OBJECT<", "STRUCT<") for x in parts)
    return _plain(T.DataType.fromDDL(ddl))


def _plain(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_plain(t.elementType))
    if isinstance(t, T.DecimalType):
        return T.DoubleType() if t.scale else T.LongType() if t.precision <= 18 else T.DoubleType()
    if isinstance(t, (T.NullType, T.VariantType)):
        return T.StringType()
    return t


def read_json_inferred(spark: SparkSession, path: str, schema_path: str) -> DataFrame:
    """S6 without a given schema: it is inferred from all lines once, stored at
    ``schema_path``, and taken from there by later reads, so that a column
    keeps its type from run to run. Delete the stored one to infer anew."""
    if not target_exists(spark, schema_path):
        schema = json_schema(read_log_lines(spark, path))
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(schema_path)
    stored = T.StructType.fromJson(json.loads(spark.read.text(schema_path, wholetext=True).first()["value"]))
    return read_json(spark, path, schema=stored)
