"""Registered queries of the corpus operators, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from laborlake.llm import (
    conversation_repair,
    decontaminate,
    exact_dedup,
    html_text,
    mixing,
    quality,
    quality_rules,
    sharding,
    simhash,
    token_alignment,
    token_counts,
    token_output,
    url_filter,
)

QUERIES = {
    "op1_simhash_near_dedup": simhash.query,
    "op2_quality_classifier": quality.query,
    "op3_sharding": sharding.query,
    "op4_mixing": mixing.query,
    "op5_url_filters": url_filter.query,
    "op6_html_extraction": html_text.query,
    "op7_exact_dedup": exact_dedup.query,
    "op8_token_counts": token_counts.query,
    "op9_benchmark_decontamination": decontaminate.query,
    "op10_token_output": token_output.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_token_alignment": token_alignment.query,
    "op13_quality_rules": quality_rules.query,
}
ORACLE_SQL = {
    "op5_url_filters": url_filter.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
}
