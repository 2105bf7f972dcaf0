"""Bindings of the jobs' input tables onto the driver's test tables.

The jobs read tables that do not exist in the test data (client intents,
listings, raw log folders). These functions derive them, with Spark, from the
given tables so every query's work grows with the data:

* listings from ``part``; client intents from ``orders``;
* raw ``||`` event-log lines rendered from ``events``; page-log lines from
  ``pages``; user facts for segment rules from ``events``.

The same derivations are written in SQL in ``strata.plans.oracles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.session import read_table

_TYPES = ["MEDIUM", "PROMO", "SMALL", "STANDARD", "ECONOMY", "LARGE"]


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 10th part is shared twice, so it is two listings."""
    p = read_table(spark, sf_dir, "part")
    shares = F.when(F.col("p_partkey") % 10 == 0, F.array(F.col("p_partkey"), F.col("p_partkey") + 10_000_000)).otherwise(
        F.array("p_partkey"))
    return p.select(
        F.col("p_partkey").alias("fh_id"),
        F.explode(shares).alias("share_id"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") % 5 + 1).alias("room"),
        F.col("p_brand").alias("area"),
        F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")).alias("place"),
        (F.col("p_partkey") % 3 + 1).cast("int").alias("rs_type"),
    )


def intents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client intents; one in ten has a 2-part ``area_code`` (to be rejected)."""
    o = read_table(spark, sf_dir, "orders")
    brand = F.concat(F.lit("Brand#"), (F.col("o_custkey") % 25 + 1).cast("string"))
    ptype = F.element_at(F.array(*[F.lit(t) for t in _TYPES]), (F.col("o_custkey") % 6 + 1).cast("int"))
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    area_code = F.concat(
        F.lit("01-"), brand,
        F.when(F.col("o_orderkey") % 10 == 9, F.lit(""))
         .otherwise(F.concat(F.lit("-"), brand, F.lit("/"), ptype)))
    return o.select(
        F.col("o_orderkey").alias("rid"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("cid"),
        day.alias("see_time"),
        day.alias("update_time"),
        area_code.alias("area_code"),
        (F.lit(900) + F.col("o_orderkey") % 60).cast("double").alias("price_start"),
        (F.lit(940) + F.col("o_orderkey") % 60).cast("double").alias("price_end"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("1,2")).otherwise(F.lit("3,4,5")).alias("house_type"),
        (F.col("o_orderkey") % 5).cast("int").alias("require_type"),
    )


# --- raw log lines -----------------------------------------------------------

def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` rendered as 15-field ``||`` lines (``value`` column).

    Every 11th line carries a binary prefix before a NUL; every 7th has an
    empty payload, so its trailing empty field drops and the line is rejected;
    every 5th payload repeats ``uid`` and carries a ``%`` and padded value.
    """
    e = read_table(spark, sf_dir, "events")
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    uid = F.col("user_id").cast("string")
    payload = (
        F.when(F.col("event_id") % 7 == 0, F.lit(""))
        .when(F.col("event_id") % 5 == 0,
              F.concat(F.lit("uid=x&eId="), F.col("event_type"), F.lit("&uid= "), uid,
                       F.lit(" &obj="), F.format_string("%.2f", "value"),
                       F.lit("&bd=b%20"), (F.col("event_id") % 3).cast("string"), F.lit("&junk")))
        .otherwise(F.concat(F.lit("eId="), F.col("event_type"), F.lit("&uid="), uid,
                            F.lit("&obj="), F.format_string("%.2f", "value")))
    )
    fields = [
        F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("\u0001\u0000"), ts)).otherwise(ts),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                 (F.col("event_id") % 256).cast("string")),
        F.lit("wx"),
        F.concat(F.lit("U"), uid),
        F.lit("app1"),
        F.lit("1.0"),
        F.when(F.col("user_id") % 2 == 0, F.lit("ios")).otherwise(F.lit("android")),
        F.concat(F.lit("m"), (F.col("user_id") % 9).cast("string")),
        F.lit("wifi"),
        F.lit(""),
        F.lit("114.1"),
        F.lit("22.5"),
        F.concat(F.lit("s"), (F.col("event_id") % 97).cast("string")),
        F.concat(F.lit("r"), (F.col("user_id") % 13).cast("string")),
        payload,
    ]
    return e.select(F.concat_ws("||", *fields).alias("value"))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` rendered as 21-field ``||`` page-log lines."""
    p = read_table(spark, sf_dir, "pages")
    pid = F.col("page_id").cast("string")
    payload = F.concat(
        F.lit("pId="), pid, F.lit("&st="), (F.col("page_id") % 97).cast("string"),
        F.lit("&uid="), (F.col("page_id") % 13).cast("string"),
        F.when(F.col("page_id") % 4 == 0, F.lit("&bd= ios &et=9%2&osv=17")).otherwise(F.lit("&et=1")),
    )
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    fields = [
        F.when(F.col("page_id") % 9 == 0, F.concat(F.lit("bin\u0000"), pid)).otherwise(pid),
        F.lit("10.1.0.1"), F.lit("web"), F.concat(F.lit("U"), pid), F.lit("a1"), F.lit("ss"),
        F.lit("2.0"), F.lit("linux"), host, F.lit("4g"), F.lit("cm"), F.lit("114.0"), F.lit("22.0"),
        F.lit("ch"), F.lit("mac"), F.lit("imei"), F.lit("idfa"), F.lit("imsi"),
        F.concat(F.lit("s"), pid), F.lit("src"), payload,
    ]
    return p.select(F.concat_ws("||", *fields).alias("value"))


def user_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment-rule facts: one row per event, ``uuid`` and ``l_date`` added."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("uuid"),
        F.date_format("ts", "yyyy-MM-dd").alias("l_date"),
        "user_id", "event_type", "value", "event_id",
    )
