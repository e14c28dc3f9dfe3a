"""Queries with SQL against their SQL, and the columns of all of them."""

import pytest

import __spark_entry__ as entry_point
from cellframe.llm.queries import QUERIES, SQL
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = connect(SF_DIR)
    assert compare(con, QUERIES[name](spark, SF_DIR), SQL[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name, columns", [
    ("op2_quality_classifier", ["doc_id", "held_out", "score", "predicted"]),
    ("op4_language_id", ["doc_id", "held_out", "lang_pred", "score"]),
    ("op5_html_text", ["page_id", "url", "text", "n_chars"]),
    ("op6_near_dedup", ["doc_id", "n_shingles", "component_id", "kept"]),
    ("op8_quality_rules", ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]),
    ("op10_url_filter", ["page_id", "host", "path", "rule", "verdict"]),
    ("op11_simhash", ["doc_id", "fingerprint", "component_id"]),
    ("op12_token_alignment", ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]),
    ("op13_lexical_search", ["item_id", "rank", "doc_id", "score"]),
])
def test_contract_columns(spark, name, columns):
    assert QUERIES[name](spark, SF_DIR).columns[: len(columns)] == columns
