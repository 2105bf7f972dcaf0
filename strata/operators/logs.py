"""Parsers for ``||``-delimited app logs with a key/value payload.

One ``select`` of column expressions per log kind: arity check, NUL-prefix
strip, positional fields, payload look-ups and the processing date. No RDD
step and no Python per row, so the whole parse is one codegen stage that
runs wherever the text scan runs (batch or stream).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.clock import run_date
from strata.functions.kv import with_values
from strata.functions.text import exact_fields, has_exact_fields, jvm_split_size, strip_nul_prefix

SEP = r"\|\|"


@dataclass(frozen=True)
class LogSpec:
    """Layout of one log kind.

    raw: names of the positional fields, payload last.
    keys: output column -> payload key.
    columns: output order (the partition column ``l_date`` is appended).
    extra: output column -> function(payload) for derived columns.
    """
    raw: tuple
    keys: dict
    columns: tuple
    extra: dict


def _page_id(payload: Column) -> Column:
    # text before the first '&st=', with every literal 'pId=' removed
    return F.replace(F.substring_index(payload, "&st=", 1), F.lit("pId="), F.lit(""))


# Field layouts of the two log kinds.
PAGE_SPEC = LogSpec(
    raw=(
        "it",
        "ip",
        "logsource",
        "uuid",
        "aid",
        "ssid",
        "ver",
        "ost",
        "model",
        "bi_nt",
        "bi_np",
        "bi_lng",
        "bi_lat",
        "channel",
        "mac",
        "imei",
        "idfa",
        "imsi",
        "sid",
        "srcid",
        "payload",
    ),
    keys={"st": "st", "bd": "bd", "osv": "osv", "uid": "uid", "et": "et", "scs": "scs",
          "osl": "osl", "dpi": "dpi", "bat": "bat"},
    columns=(
        "it",
        "ip",
        "logsource",
        "uuid",
        "aid",
        "ssid",
        "ver",
        "ost",
        "model",
        "bi_nt",
        "bi_np",
        "bi_lng",
        "bi_lat",
        "channel",
        "mac",
        "imei",
        "idfa",
        "imsi",
        "pid",
        "st",
        "bd",
        "osv",
        "uid",
        "et",
        "scs",
        "osl",
        "dpi",
        "bat",
        "sid",
        "srcid",
    ),
    extra={"pid": _page_id},
)

EVENT_SPEC = LogSpec(
    raw=(
        "request_time",
        "ip",
        "http_logsource",
        "http_uuid",
        "http_aid",
        "http_version",
        "http_phoneos",
        "http_phonemodel",
        "http_network",
        "http_carries",
        "http_longitude",
        "http_latitude",
        "sid",
        "srcid",
        "payload",
    ),
    keys={"bd": "bd", "osv": "osv", "uid": "uid", "eid": "eId", "obj": "obj", "scs": "scs",
          "osl": "osl", "dpi": "dpi", "bat": "bat"},
    columns=(
        "request_time",
        "ip",
        "http_logsource",
        "http_uuid",
        "http_aid",
        "http_version",
        "http_phoneos",
        "http_phonemodel",
        "http_network",
        "http_carries",
        "http_longitude",
        "http_latitude",
        "bd",
        "osv",
        "uid",
        "eid",
        "obj",
        "scs",
        "osl",
        "dpi",
        "bat",
        "sid",
        "srcid",
    ),
    extra={},
)


def valid_lines(lines: DataFrame, spec: LogSpec, col: str = "value") -> Column:
    return has_exact_fields(col, SEP, len(spec.raw))


def parse_log(lines: DataFrame, spec: LogSpec, run_ts, col: str = "value", keep: tuple = ()) -> DataFrame:
    """Parse the lines of ``col`` that have exactly ``len(spec.raw)`` fields.

    A line is split once: the test keeps or drops its fields (``exact_fields``),
    which are then taken by position. The payload's tokens and keys are built
    once, whatever the number of keys. Columns of ``lines`` in ``keep`` come last.
    """
    n = len(spec.raw)
    fields = lines.select(*keep, F.explode(exact_fields(col, SEP, n)).alias("_fields"))
    raw = {name: F.get("_fields", i) for i, name in enumerate(spec.raw)}
    raw[spec.raw[0]] = strip_nul_prefix(raw[spec.raw[0]])
    payload = spec.raw[-1]
    staged = with_values(fields.select(*keep, *[c.alias("_f_" + name) for name, c in raw.items()]), "_f_" + payload,
                         {"_k_" + name: key for name, key in spec.keys.items()})
    out = []
    for name in spec.columns:
        if name in spec.extra:
            out.append(spec.extra[name](F.col("_f_" + payload)).alias(name))
        else:
            out.append(F.col(("_k_" if name in spec.keys else "_f_") + name).alias(name))
    return staged.select(*out, run_date(run_ts).alias("l_date"), *keep)


def parse_page_log(lines: DataFrame, run_ts, col: str = "value") -> DataFrame:
    return parse_log(lines, PAGE_SPEC, run_ts, col)


def parse_event_log(lines: DataFrame, run_ts, col: str = "value") -> DataFrame:
    return parse_log(lines, EVENT_SPEC, run_ts, col)


def rejected_lines(lines: DataFrame, spec: LogSpec, col: str = "value") -> DataFrame:
    """Lines the parser drops, with their field count under the JVM split rule."""
    return lines.where(~has_exact_fields(col, SEP, len(spec.raw))).select(
        F.col(col).alias("line"), jvm_split_size(col, SEP).alias("n_fields"))


def field_count_profile(lines: DataFrame, sep_regex: str, col: str = "value") -> DataFrame:
    """How many lines have each field count (JVM split rule)."""
    return (lines.select(jvm_split_size(col, sep_regex).alias("n_fields"))
            .groupBy("n_fields").agg(F.count(F.lit(1)).alias("lines")))


def lines_with_fields(lines: DataFrame, sep_regex: str, n: int, col: str = "value") -> DataFrame:
    """The lines with exactly ``n`` fields, as ``(line, n_fields)``."""
    return lines.where(has_exact_fields(col, sep_regex, n)).select(
        F.col(col).alias("line"), F.lit(n).alias("n_fields"))


def max_line(lines: DataFrame, sep_regex: str, col: str = "value") -> DataFrame:
    """Largest ``(line, n_fields)`` tuple, compared line first."""
    t = F.struct(F.col(col).alias("line"), jvm_split_size(col, sep_regex).alias("n_fields"))
    return lines.agg(F.max(t).alias("m")).select("m.line", "m.n_fields")
