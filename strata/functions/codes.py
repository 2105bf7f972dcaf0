"""Code mappings used by the matching jobs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from strata.functions.text import _c

# Client require_type -> listing rs_type.
# 1 -> 1, 2 -> 2, 4 -> 2, anything else (null reads as 0) -> 3.
REQUIRE_TO_RS = {1: 1, 2: 2, 4: 2}
RS_OTHER = 3


def rs_type_of(require_type) -> Column:
    c = F.coalesce(_c(require_type).cast("int"), F.lit(0))
    expr = None
    for k, v in REQUIRE_TO_RS.items():
        expr = (F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v)))
    return expr.otherwise(F.lit(RS_OTHER))
