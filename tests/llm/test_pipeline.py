"""Every stage of the pipeline on its own input, and what the whole run leaves."""

import pytest

import corpus_pipeline as cp
from cellframe.llm.shared import table

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents").cache()
    before = {r.doc_id: r.text for r in docs.collect()}
    told = cp.identify_language(spark, docs, SF_DIR)
    assert told.columns == docs.columns and told.count() == len(before)
    lined = cp.dedup_lines(spark, docs, SF_DIR)
    after = {r.doc_id: r.text for r in lined.collect()}
    assert lined.columns == docs.columns
    long = [x for t in after.values() for x in t.split("\n") if len(x) >= 30]
    assert len(long) == len(set(long)) == len({x for t in before.values() for x in t.split("\n") if len(x) >= 30} & set(long))
    assert {i for i in before if i not in after} <= {i for i, t in before.items() if sum(t == u for u in before.values()) > 1}
    near = cp.dedup_documents(spark, docs, SF_DIR)
    left = [r.text for r in near.collect()]
    assert near.columns == docs.columns and len(left) == len(set(left)) < len(before)
    items = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
    clean = cp.decontaminate(spark, docs, SF_DIR)
    kept = {r.doc_id for r in clean.collect()}
    assert clean.columns == docs.columns
    assert {i for i in before if i not in kept} == {i for i, t in before.items() if any(x in t for x in items)}


def test_run(spark):
    out = cp.run(spark, SF_DIR)
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]
    assert out.columns == table(spark, SF_DIR, "documents").columns + ["copy", "n_copies", "mix_key"]
    assert not out.isEmpty()


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_odd_rows(spark, odd_docs, no_docs, name):
    stage = dict(cp.STAGES)[name]
    out = stage(spark, odd_docs, SF_DIR)
    assert out.columns[: len(odd_docs.columns)] == odd_docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert set(ids) <= {r.doc_id for r in odd_docs.collect()}
    if name == "language_id":
        assert sorted(i or 0 for i in ids) == [0, 1, 2, 3, 7, 7, 9]
    if name == "line_dedup":
        assert 1 in ids and 2 not in ids and {4, 5, 6} <= set(ids)
    if name == "near_dedup":
        assert 1 in ids and 2 not in ids and ids.count(7) == 2 and {None, 4, 5, 6} <= set(ids)
    assert stage(spark, no_docs, SF_DIR).isEmpty()
