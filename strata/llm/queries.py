"""Registered queries of the package and their SQL."""

from __future__ import annotations

from strata.llm.decontaminate import OP7_SQL, op7_decontaminate
from strata.llm.html_text import op5_main_text
from strata.llm.merkle import OP11_SQL, op11_manifest
from strata.llm.mixing import OP12_SQL, op12_mixing
from strata.llm.near_duplicates import OP2_SQL, op2_jaccard
from strata.llm.neighbours import op4_neighbours
from strata.llm.packing import op8_packing
from strata.llm.passages import OP10_SQL, op10_passages
from strata.llm.quality import op1_quality
from strata.llm.token_counts import op6_token_counts
from strata.llm.toxicity import op3_toxicity
from strata.llm.url_filter import OP9_SQL, op9_url_filter
from strata.llm.whitening import op13_whitening

QUERIES = {f.__name__: f for f in (
    op1_quality, op2_jaccard, op3_toxicity, op4_neighbours, op5_main_text, op6_token_counts, op7_decontaminate,
    op8_packing, op9_url_filter, op10_passages, op11_manifest, op12_mixing, op13_whitening)}

ORACLES = {
    "op2_jaccard": OP2_SQL,
    "op7_decontaminate": OP7_SQL,
    "op9_url_filter": OP9_SQL,
    "op10_passages": OP10_SQL,
    "op11_manifest": OP11_SQL,
    "op12_mixing": OP12_SQL,
}
