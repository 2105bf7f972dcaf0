"""Key/value payloads such as ``eId=click&uid=7&bd=x%20y``.

Rules (kept from the jobs we match): pairs are separated by ``&``; the first
``=`` splits key from value; the value ends at the first ``%``; key and value
are trimmed with Java's trim; a token without ``=`` is ignored; the last
duplicate wins; a missing key gives null. ``str_to_map`` cannot be used: it
raises on duplicate keys and does not cut at ``%``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.text import java_trim, _c


def kv_tokens(col) -> Column:
    """The payload's tokens, last one first."""
    return F.reverse(F.split(_c(col), "&", -1))


def kv_keys(tokens) -> Column:
    """The key of each token; null for one without ``=``."""
    return F.transform(_c(tokens), lambda t: F.when(F.instr(t, "=") > 0, java_trim(F.substring_index(t, "=", 1))))


def _value(token: Column) -> Column:
    return java_trim(F.substring_index(F.substr(token, F.instr(token, "=") + 1), "%", 1))


def kv_at(tokens, keys, key: str) -> Column:
    """Value of ``key`` by the tokens and their keys: the first position is the
    last occurrence. Without one, position -1 gives null."""
    at = F.array_position(_c(keys), F.lit(key)) - 1
    return _value(F.get(_c(tokens), at.cast("int")))


def kv_get(col, key: str) -> Column:
    """Value of ``key`` in a payload column (last occurrence wins)."""
    tokens = kv_tokens(col)
    return kv_at(tokens, kv_keys(tokens), key)


def with_values(df: DataFrame, payload: str, keys: dict[str, str]) -> DataFrame:
    """``df`` with one more column for each of ``keys`` (output column ->
    payload key). Tokens and keys are columns of their own, so they are built
    once for all look-ups."""
    own = df.columns
    staged = df.withColumn("_tokens", kv_tokens(payload)).withColumn("_keys", kv_keys("_tokens"))
    return staged.select(*own, *[kv_at("_tokens", "_keys", k).alias(c) for c, k in keys.items()])


def kv_map(col) -> Column:
    """The whole payload as ``map<string,string>`` with last-wins keys.

    Entries are sorted by key and place, so the last of each key is the one
    before another key: n log n for n tokens.
    """
    tokens = F.filter(F.split(_c(col), "&", -1), lambda t: F.instr(t, "=") > 0)
    entries = F.array_sort(F.transform(tokens, lambda t, i: F.struct(
        java_trim(F.substring_index(t, "=", 1)).alias("key"), i.alias("place"), _value(t).alias("value"))))

    def last(all_: Column) -> Column:
        kept = F.filter(all_, lambda e, i: ~F.coalesce(F.get(all_, i + 1)["key"] == e["key"], F.lit(False)))
        return F.map_from_arrays(F.transform(kept, lambda e: e["key"]), F.transform(kept, lambda e: e["value"]))

    # the lambda binds the sorted entries, so they are sorted once
    return F.get(F.transform(F.array(entries), last), 0)
