"""Delimited-text helpers with the JVM ``String.split`` / ``String.trim`` rules.

The jobs we match split lines with ``String.split(regex)``, which drops
trailing empty strings, while Spark's ``split`` keeps them. Lines whose last
fields are empty therefore have a smaller arity under the JVM rule.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Fixed value: Java's String.trim removes every char <= U+0020 from both ends.
_JAVA_WS = r"[\x00-\x20]"
_JAVA_WS_CHARS = "".join(chr(i) for i in range(0x21))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_trim(col) -> Column:
    # a character-set trim (plain scan, no regex)
    return F.trim(_c(col), F.lit(_JAVA_WS_CHARS))


def split_fields(col, sep_regex: str) -> Column:
    """All fields, trailing empties kept (Spark's rule)."""
    return F.split(_c(col), sep_regex, -1)


def jvm_split(col, sep_regex: str) -> Column:
    """``String.split(regex)``: trailing empty fields dropped; '' -> ['']."""
    c = _c(col)
    parts = F.split(c, sep_regex, -1)
    last = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
    return F.when(c == "", F.array(F.lit(""))).otherwise(F.slice(parts, 1, last))


def jvm_split_size(col, sep_regex: str) -> Column:
    """Number of fields under the ``String.split(regex)`` rule.

    For a one-character separator, trailing separators are trimmed and the
    rest is split once (no lambda); '' has one field, a line of separators none.
    """
    ch = _single_char(sep_regex)
    if ch is None:
        return F.size(jvm_split(col, sep_regex))
    c = _c(col)
    body = F.rtrim(c, F.lit(ch))
    return (F.when(c == "", F.lit(1)).when(body == "", F.lit(0))
            .otherwise(F.size(F.split(body, sep_regex, -1))).cast("int"))


def _single_char(sep_regex: str) -> str | None:
    """The literal character a one-character separator regex stands for."""
    if len(sep_regex) == 1 and sep_regex not in ".$|()[]{}^?*+\\":
        return sep_regex
    if len(sep_regex) == 2 and sep_regex[0] == "\\" and not sep_regex[1].isalnum():
        return sep_regex[1]
    return None


def _doubled_char(sep_regex: str) -> str | None:
    """The character of a separator written as one escaped character twice (``\\|\\|``)."""
    if len(sep_regex) == 4 and sep_regex[0] == sep_regex[2] == "\\" and \
            sep_regex[1] == sep_regex[3] and not sep_regex[1].isalnum():
        return sep_regex[1]
    return None


def exact_fields(col, sep_regex: str, n: int) -> Column:
    """An array that holds the line's first ``n`` fields (and the rest, as one
    more) if ``String.split(regex)`` would give exactly ``n`` fields, and
    nothing otherwise. Exploded, it filters and splits lines in one split.

    The split stops after ``n`` separators: field ``n`` must not be empty, and
    what follows must be separators only (of ``||``, an even run of ``|``).
    No regex alternation, which the JVM engine would evaluate recursively. The
    lambda binds the fields, so the line is split once.
    """
    return F.filter(F.array(F.split(_c(col), sep_regex, n + 1)), lambda parts: _exact(parts, sep_regex, n))


def _exact(parts: Column, sep_regex: str, n: int) -> Column:
    rest = F.get(parts, n)
    single, doubled = _single_char(sep_regex), _doubled_char(sep_regex)
    if single is not None:
        empty = F.translate(rest, single, "") == ""
    elif doubled is not None:
        empty = (F.translate(rest, doubled, "") == "") & (F.length(rest) % 2 == 0)
    else:
        empty = F.concat_ws("", F.split(rest, sep_regex, -1)) == ""
    last = F.get(parts, n - 1)
    if n == 1:  # '' has one field
        return (F.size(parts) == 1) | ((last != "") & empty)
    return (F.size(parts) >= n) & (last != "") & ((F.size(parts) == n) | empty)


def has_exact_fields(col, sep_regex: str, n: int) -> Column:
    """True when ``String.split(regex)`` would give exactly ``n`` fields.

    For a one-character separator it is one anchored regex whose loops are all
    character classes (iterative in the JVM regex engine, so safe on very long
    lines): fields 1..n-1 any, field n non-empty, then only separators. For
    others the line is split once (``exact_fields``).
    """
    c = _c(col)
    ch = _single_char(sep_regex)
    if ch is None:
        return F.coalesce(F.size(exact_fields(c, sep_regex, n)) == 1, F.lit(False))
    x = "\\" + ch if ch in "]\\^-" else ch
    pattern = r"\A(?:[^" + x + r"]*" + re.escape(ch) + "){" + str(n - 1) + r"}[^" + x + r"]+" \
        + re.escape(ch) + r"*\z"
    cond = c.rlike(pattern)
    if n == 1:
        cond = cond | (c == "")
    return c.isNotNull() & cond


def strip_nul_prefix(col) -> Column:
    """Text after the last NUL, ignoring trailing NULs (binary log prefix)."""
    return F.substring_index(F.rtrim(_c(col), F.lit("\u0000")), "\u0000", -1)
