import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellframe.llm import token_counts as tc


def brute_force(ends, sections, rule):
    counts, crossing, before = [0.0] * len(sections), [0] * len(sections), 0
    for end in ends:
        shares = [max(0, min(end, b) - max(before, a)) for a, b in sections]
        for i, share in enumerate(shares):
            crossing[i] += 0 < share < end - before
            if rule == "split":
                counts[i] += share / (end - before)
            elif rule == "start":
                counts[i] += sections[i][0] <= before < sections[i][1]
        if rule == "most" and any(shares):
            counts[max(range(len(sections)), key=lambda i: (shares[i], -sections[i][0]))] += 1
        before = end
    return counts, crossing


@pytest.mark.parametrize("rule", tc.RULES)
def test_attribution_equals_brute_force(rule):
    random.seed(6)
    for _ in range(2_000):
        ends = np.cumsum([random.randrange(1, 5) for _ in range(random.randrange(12))]).astype(np.int64)
        cuts = sorted(random.choices(range(int(ends[-1]) + 1 if len(ends) else 1), k=2 * random.randrange(5)))
        sections = list(zip(cuts[::2], cuts[1::2])) if random.random() < 0.5 else list(zip(cuts, cuts[1:]))
        random.shuffle(sections)
        a, b = (np.array([s[i] for s in sections], np.int64) for i in (0, 1))
        got, crossing = tc.attribute(ends, a, b, rule)
        want = brute_force(ends.tolist(), sections, rule)
        assert np.allclose(got, want[0]) and crossing.tolist() == want[1]


def test_tokens_rebuild_the_text_and_add_up(spark):
    rows = [(1, "One line.\n\n\nTwo  lines é 中文 😀\n"), (2, "<|endoftext|> x" * 50), (3, "a\n" * 2_000)]
    encoder = tc.Encoder(tc.VOCABULARY_FILE)
    for _, text in rows:
        ids = encoder.encoding.encode_ordinary(text)
        assert encoder.encoding.decode(ids) == text and encoder.ends(text)[-1] == len(text.encode())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for rule in tc.RULES:
        out = tc.count_tokens(df, rule=rule).groupBy("doc_id").agg(
            F.sum("n_tokens").alias("n"), F.first("doc_tokens").alias("all"), F.count("*").alias("lines"))
        got = {r.doc_id: (round(r.n, 6), r.all, r.lines) for r in out.collect()}
        assert got == {i: (len(encoder.ends(t)), len(encoder.ends(t)), t.count("\n") + 1) for i, t in rows}


def test_given_sections(spark):
    df = spark.createDataFrame([(1, "Title: body of text", "x")], "doc_id long, text string, section string")
    spans = F.array(F.struct(F.lit(6).alias("start"), F.lit(99).alias("end")), F.struct(F.lit(0).alias("start"), F.lit(6).alias("end")))
    got = [(r.section, r.start, r.end, r.n_tokens) for r in tc.count_tokens(df, spans).orderBy("section").collect()]
    assert got == [(0, 6, 19, 3.0), (1, 0, 6, 2.0)]
    with pytest.raises(ValueError):
        tc.count_tokens(df, rule="none")


def test_odd_rows(odd_docs, no_docs):
    rows = tc.count_tokens(odd_docs).collect()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[4].n_tokens == 0 and by_id[5].doc_tokens == 0 and by_id[5].section == 0
    assert sum(r.doc_id == 7 for r in rows) == 2 and by_id[9].doc_tokens >= 30_000 and by_id[None].n_tokens > 0
    none = tc.count_tokens(odd_docs, F.expr("CAST(NULL AS array<struct<start: int, end: int>>)")).collect()
    assert len(none) == odd_docs.count() and {r.section for r in none} == {None}
    assert tc.count_tokens(no_docs).isEmpty()
