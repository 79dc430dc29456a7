"""Queries of the corpus operators, and the same in SQL where SQL can express them."""

from __future__ import annotations

from pairtables.llm import (
    chat_format, decontaminate, exact_dedup, html_wrappers, line_dedup, mixing, ngram_join,
    periodic_runs, quality, token_alignment, topk_search, toxicity, url_rules,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_chat_format": chat_format.op5_chat_format,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_quality": quality.op7_quality,
    "op8_url_rules": url_rules.op8_url_rules,
    "op9_html_text": html_wrappers.op9_html_text,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_topk_search": topk_search.op12_topk_search,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}
ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op3_exact_dedup": exact_dedup.ORACLE_SQL,
    "op5_chat_format": chat_format.ORACLE_SQL,
    "op8_url_rules": url_rules.ORACLE_SQL,
    "op10_ngram_join": ngram_join.ORACLE_SQL,
    "op12_topk_search": topk_search.ORACLE_SQL,
}
