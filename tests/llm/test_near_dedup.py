import random
import re
from itertools import combinations

import numpy as np
import pytest

from cellframe.llm import near_dedup
from cellframe.llm.linking import components


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


@pytest.mark.parametrize("k, percent", [(2, 80), (5, 80)])
def test_equals_brute_force(spark, k, percent):
    random.seed(k)
    words = [f"w{i}" for i in range(400)] + ["Ünd", "THE", "the"]
    docs = []
    for i in range(40):
        text = random.choices(words, k=random.randrange(0, 120))
        for _ in range(random.randrange(1, 6)):
            copy = list(text)
            for _ in range(random.randrange(0, 8)):
                if copy:
                    copy[random.randrange(len(copy))] = random.choice(words)
            docs.append((len(docs), random.choice([" ", "\t", "\x0b "]).join(copy)))
    sets = {i: shingles(t, k) for i, t in docs}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    rows = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def test_registers_merge_and_estimate():
    random = np.random.default_rng(1)
    a = random.integers(0, 1 << 63, 3_000, dtype=np.uint64)
    both = np.unique(np.concatenate([a, random.integers(0, 1 << 63, 1_000, dtype=np.uint64)]))
    x, y = near_dedup.registers(a), near_dedup.registers(both)
    # the register of a union is the larger one, as its minimum is the smaller one
    rest = np.setdiff1d(both, a)
    assert (np.maximum(x, near_dedup.registers(rest)) == y).all()
    assert abs((x == y).mean() - 0.75) < 0.2


def test_likelihood_peak(spark):
    random = np.random.default_rng(2)
    rows, want = [], []
    for share in (0.0, 0.5, 0.8, 1.0):
        common = random.integers(0, 1 << 63, int(2_000 * share) + 1, dtype=np.uint64)
        a = np.unique(np.append(common, random.integers(0, 1 << 63, 2_001 - len(common), dtype=np.uint64)))
        b = np.unique(np.append(common, random.integers(0, 1 << 63, 2_001 - len(common), dtype=np.uint64)))
        sketch = [bytearray(near_dedup.registers(s).astype(">u2").tobytes()) for s in (a, b)]
        rows.append(((len(a), sketch[0]), (len(b), sketch[1])))
        want.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    df = spark.createDataFrame(rows, "x struct<n: long, sketch: binary>, y struct<n: long, sketch: binary>")
    got = [r[0] for r in df.selectExpr(near_dedup.likelihood_peak("x", "y")).collect()]
    assert np.allclose(got, want, atol=0.15)


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1_000, 1_000 + i) for i in range(1, 300)] + [(5_001, 5_000), (7, 7)]
    got = {r.id: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1_000 + i: 1_000 for i in range(300)}, 5_000: 5_000, 5_001: 5_000}


def test_odd_rows(odd_docs, no_docs):
    rows = near_dedup.near_duplicates(odd_docs).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert len(rows) == odd_docs.count()
    assert got[1][1:] == (1, True) and got[2][1:] == (1, False)
    assert got[4] == (0, 4, True) and got[5] == (0, 5, True) and got[6] == (0, 6, True)
    assert got[7] == (1, 7, True) and got[9] == (1, 9, True) and got[None][1:] == (None, True)
    assert near_dedup.near_duplicates(no_docs).isEmpty()
