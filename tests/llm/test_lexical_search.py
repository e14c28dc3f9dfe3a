import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cellframe.llm import lexical_search as L

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, top):
    """All documents against all items, term by term."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    of_items = {}
    for i, t in items:
        of_items.setdefault(i, set()).update(plain_terms(t))
    found = set()
    for item, terms in of_items.items():
        scores = []
        for doc, c, n in counted:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1):
            found.add((item, rank, doc, -score))
    return found


def made(n, seed):
    """Documents of few words, so that scores are often equal."""
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma42", "été", "中文", "x", "Delta-delta", "of", "the", "of the"]
    return [(i, " ".join(r.choices(words, k=r.choice([0, 1, 2, 3, 3, 8, 40])))) for i in range(n)]


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_terms_equal_the_pattern(monkeypatch):
    monkeypatch.setattr(L, "PIECE", 5)
    for text in [None, "", "A-Z a_z [b] `c` {d} é\x7fÀ9\x00x\x85y", "İI ſ K " * 9, "".join(map(chr, range(300)))]:
        got = Counter()
        for counts in L.term_counts(text.encode() if text is not None else None):
            got += counts
        assert got == Counter(t.encode() for t in plain_terms(text))


@pytest.mark.parametrize("part_terms, tile_items, tile_docs, columns, held", [
    (500_000, 256, 512, 4_096, 50_000), (4, 1, 7, 2, 0), (9, 3, 64, 1, 20),
])
def test_equals_plain_search(spark, monkeypatch, part_terms, tile_items, tile_docs, columns, held):
    for name, value in [("TILE_ITEMS", tile_items), ("TILE_DOCS", tile_docs), ("COLUMNS", columns), ("HELD", held)]:
        monkeypatch.setattr(L, name, value)
    docs = made(400, 1) + [(None, "alpha of beta"), (None, "alpha"), (7, "alpha"), (7, "alpha"), (401, None)]
    items = [(f"i{i}", t) for i, t in made(12, 2)] + [("i1", "x x alpha"), (None, "of"), ("none", "absent"), ("empty", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    i = spark.createDataFrame(items, "item_id string, text string")
    for top in (1, 50):
        assert rows_of(L.search(d, i, top, part_terms)) == plain_search(docs, items, top)


def test_sums_beyond_one_slice_stay_exact():
    """Weights so large that the vocabulary must be cut, although the columns would fit."""
    weights = np.array([3_000_000_001, 2_999_999_999, 3_100_000_007, 5], np.int64)
    tile = L.Tile(np.array([0]), [np.arange(4)], weights, 3)
    assert len(tile.slices) > 1
    for start, stop, _ in tile.slices:
        assert int(weights[tile.columns[start:stop]].sum()) * L.MOST_IMPACT < 2**53
    impact = np.array([999_999, 999_998, 999_997, 3], np.int64)
    tile.add(np.zeros(4, np.int64), np.arange(4), impact, np.array([8]), np.array([False]))
    assert tile.found[1].tolist() == [sum(int(w) * int(x) for w, x in zip(weights, impact))]
    with pytest.raises(OverflowError):
        L.Tile(np.array([0]), [np.arange(1)], np.array([2**50]), 3)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "The quick word", 5), (2, "", 5)], "item_id int, text string, rank int")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows_of(L.search(odd_docs, items)) == plain_search(docs, [(1, "The quick word"), (2, "")], 50)
    assert L.search(no_docs, items).isEmpty() and L.search(odd_docs, items.limit(0)).isEmpty()
    assert L.search(odd_docs, items).columns == ["item_id", "rank", "doc_id", "score"]
