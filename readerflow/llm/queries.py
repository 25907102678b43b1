"""Queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

import corpus_pipeline

from . import op3_line_dedup, op4_warc, op11_importance, op12_lexical_search, op13_url_filters
from .op1_quality_fm import op1
from .op2_quality_rules import op2
from .op3_line_dedup import op3
from .op4_warc import op4
from .op5_html_extract import op5
from .op6_suffix_dedup import op6
from .op7_packing import op7
from .op8_decontaminate import op8
from .op9_toxicity import op9
from .op10_near_dedup import op10
from .op11_importance import op11
from .op12_lexical_search import op12
from .op13_url_filters import op13

QUERIES = {
    "op1_quality_fm": op1,
    "op2_quality_rules": op2,
    "op3_line_dedup": op3,
    "op4_warc": op4,
    "op5_html_extract": op5,
    "op6_suffix_dedup": op6,
    "op7_packing": op7,
    "op8_decontaminate": op8,
    "op9_toxicity": op9,
    "op10_near_dedup": op10,
    "op11_importance": op11,
    "op12_lexical_search": op12,
    "op13_url_filters": op13,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op3_line_dedup": op3_line_dedup.ORACLE,
    "op4_warc": op4_warc.ORACLE,
    "op11_importance": op11_importance.ORACLE,
    "op12_lexical_search": op12_lexical_search.ORACLE,
    "op13_url_filters": op13_url_filters.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
