"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from strata.llm.alignment import op11_alignment
from strata.llm.fingerprints import op13_fingerprints
from strata.llm.lm_score import op2_lm_score
from strata.llm.near_dup import op3_minhash_near_dup
from strata.llm.negatives import ORACLE_SQL as NEGATIVES_SQL
from strata.llm.negatives import op12_hard_negatives
from strata.llm.packing import op4_packing
from strata.llm.pii import op7_pii
from strata.llm.quality import op8_quality_rules
from strata.llm.sentencepieces import op1_sentencepiece
from strata.llm.substring_dup import op9_substring_dup
from strata.llm.token_counts import op5_token_counts
from strata.llm.urls import ORACLE_SQL as URLS_SQL
from strata.llm.urls import op10_url_filters
from strata.llm.vector_search import ORACLE_SQL as VECTORS_SQL
from strata.llm.vector_search import op6_vector_search

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_lm_score": op2_lm_score,
    "op3_minhash_near_dup": op3_minhash_near_dup,
    "op4_packing": op4_packing,
    "op5_token_counts": op5_token_counts,
    "op6_vector_search": op6_vector_search,
    "op7_pii": op7_pii,
    "op8_quality_rules": op8_quality_rules,
    "op9_substring_dup": op9_substring_dup,
    "op10_url_filters": op10_url_filters,
    "op11_alignment": op11_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_fingerprints": op13_fingerprints,
}

#: DuckDB SQL where it can express a query.
ORACLE_SQL: dict[str, str] = {
    "op6_vector_search": VECTORS_SQL,
    "op10_url_filters": URLS_SQL,
    "op12_hard_negatives": NEGATIVES_SQL,
}
