"""The queries of this package and the SQL they must equal, where SQL can say it."""

from __future__ import annotations

from cellframe.llm import (
    decontamination, html_text, language_id, lexical_search, line_dedup, mixing, near_dedup, quality_classifier,
    quality_rules, simhash, token_alignment, token_counts, url_filter,
)

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_quality_classifier": quality_classifier.query,
    "op3_line_dedup": line_dedup.query,
    "op4_language_id": language_id.query,
    "op5_html_text": html_text.query,
    "op6_near_dedup": near_dedup.query,
    "op7_token_counts": token_counts.query,
    "op8_quality_rules": quality_rules.query,
    "op9_decontamination": decontamination.query,
    "op10_url_filter": url_filter.query,
    "op11_simhash": simhash.query,
    "op12_token_alignment": token_alignment.query,
    "op13_lexical_search": lexical_search.query,
}
SQL = {
    "op1_mixing": mixing.SQL,
    "op8_quality_rules": quality_rules.SQL,
    "op10_url_filter": url_filter.SQL,
    "op13_lexical_search": lexical_search.SQL,
}
