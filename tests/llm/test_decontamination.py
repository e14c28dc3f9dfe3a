import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from cellframe.llm import decontamination as dc
from cellframe.llm.shared import table

SF_DIR = "/root/testdata/sf0.01"


def least_edits(item: str, text: str) -> int:
    """Full table, free start and end in the text."""
    row = np.zeros(len(text) + 1, int)
    points, steps = dc.code_points(text), np.arange(len(text) + 1)
    for c in item:
        new = np.append(row[0] + 1, np.minimum(row[:-1] + (points != ord(c)), row[1:] + 1))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def changed(text: str, n: int) -> str:
    out = list(text)
    for _ in range(n):
        kind, at = random.randrange(3), random.randrange(len(out))
        if kind == 0:
            out.insert(at, random.choice("xyz é"))
        elif kind == 1:
            out[at] = random.choice("abc é")
        else:
            del out[at]
    return "".join(out)


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.25])
def test_equals_full_alignment(spark, rate):
    random.seed(8)
    words = ["alpha", "beta", "gamma", "über", "日本", "of", "the", "a"]
    make = lambda n: " ".join(random.choices(words, k=n))
    items = [(i, make(random.randrange(1, 30))) for i in range(12)]
    docs = [(0, ""), (1, None)]
    for i in range(2, 50):
        item = random.choice(items)[1]
        docs.append((i, make(random.randrange(40)) + "\n " + changed(item, random.randrange(0, 1 + len(item) // 4)).upper() + " " + make(9)))
    want = {}
    for d, text in docs:
        for i, item in items:
            item = dc.normal(item)
            edits = least_edits(item, dc.normal(text))
            if edits <= dc.edits_allowed(len(item), rate):
                want[d, i] = edits
    found = dc.find(spark.createDataFrame(docs, "doc_id long, text string"),
                    spark.createDataFrame(items, "item_id long, text string"), rate)
    assert {(r.doc_id, r.item_id): r.edits for r in found.collect()} == want


def test_pieces_and_parts_change_nothing(spark, monkeypatch):
    docs, items = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "benchmark")
    whole = {tuple(r) for r in dc.find(docs, items).collect()}
    exact = {(r.doc_id, r.item_id) for r in docs.join(items.withColumnRenamed("text", "item"), how="cross")
             .where("contains(text, item)").collect()}
    assert exact <= {x[:2] for x in whole}
    texts = [(i, dc.normal(t)) for i, t in items.select("item_id", "text").collect()]
    index = dc.Index(texts, dc.ERROR_RATE)
    monkeypatch.setattr(dc, "PIECE", 700)
    cut = {(r.doc_id, int(index.ids[i]), *found) for r in docs.collect()
           for i, found in dc.occurrences(dc.normal(r.text), index).items()}
    assert cut == whole
    monkeypatch.setattr(dc, "ITEM_CHARS", 2_000)
    assert len(list(dc.item_parts(items))) > 2
    assert {tuple(r) for r in dc.find(docs, items).collect()} == whole


def shared_line_case():
    """1,000 items with one instruction line, and a long text that repeats it, with four items in it."""
    random.seed(3)
    line = "Choose the one answer that best completes the statement:"
    make = lambda n: " ".join("".join(random.choices("abcdefgh", k=6)) for _ in range(n))
    items = [(i, dc.normal(line + " " + make(50))) for i in range(1_000)]
    text = "".join(f"{line} {make(28)} " for _ in range(500))
    for i in (5, 77, 500, 999):
        at = random.randrange(len(text))
        text = text[:at] + " " + changed(items[i][1], 20) + " " + text[at:]
    return items, dc.normal(text)


def test_frequent_grams_in_bounded_memory():
    items, text = shared_line_case()
    index = dc.Index(items, dc.ERROR_RATE)
    tracemalloc.start()
    found = dc.occurrences(text, index)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {i: e for i, (e, _) in found.items()} == {
        i: least_edits(items[i][1], text) for i in (5, 77, 500, 999)
    }
    assert peak < 100e6  # a count of all places at once takes 2 GB


@pytest.mark.parametrize("size", [1, 7, 1 << 18])
def test_slices_change_nothing(monkeypatch, size):
    random.seed(4)
    items = [(i, "".join(random.choices("ab", k=random.randrange(1, 40)))) for i in range(30)]
    index = dc.Index(items, 0.2)
    text = "".join(random.choices("ab", k=300))
    points = dc.code_points(text)
    want = set()  # counted with one number for each place of each item and band
    for i, (_, item) in enumerate(items):
        q, k = dc.gram_size(len(item), int(index.k[i])), int(index.k[i])
        counts = Counter()
        for x in range(len(text) - q + 1):
            for y in range(len(item) - q + 1):
                if text[x:x + q] == item[y:y + q]:
                    band = (x - y) // max(2 * k, 1)
                    counts.update([band, band - 1])
        want |= {(i, band) for band, n in counts.items() if n >= len(item) + 1 - q * (k + 1)}
    monkeypatch.setattr(dc, "SLICE", size)
    got = [tuple(r) for reached in index.regions(points) for r in reached.tolist()]
    assert len(got) == len(set(got)) and set(got) == want


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None, 0), (2, " ", 0), (3, "a second LINE that is  long enough", 0), (3, "row without an id", 0)],
                                  "item_id long, text string, doc_id long")
    pairs = {(r.doc_id, r.item_id) for r in dc.find(odd_docs, items).collect()}
    assert pairs == {(1, 3), (2, 3), (None, 3)}
    left = dc.clean(odd_docs, items)
    assert left.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 3, 4, 5, 6, 7, 7, 8, 9]
    assert dc.find(no_docs, items).isEmpty() and dc.find(odd_docs, items.limit(0)).isEmpty()
    assert dc.clean(odd_docs, items.limit(0)).count() == odd_docs.count()
    with pytest.raises(ValueError):
        dc.find(odd_docs, items, 0.7)
