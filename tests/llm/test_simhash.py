import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cellframe.llm import simhash as S


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    size = min(3, len(words))
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """Least index reachable, by comparing all pairs."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(fps):
        for j in range(i):
            if (x ^ fps[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(fps))]


def clustered(n, seed):
    """Fingerprints around a few centres, with chains, and others apart."""
    r = random.Random(seed)
    found = [r.getrandbits(64) for _ in range(n // 3)]
    while len(found) < n:
        x = r.choice(found)
        for b in r.sample(range(64), r.randrange(0, 6)):
            x ^= 1 << b
        found.append(x)
    r.shuffle(found)
    return found


def test_fingerprint_equals_plain_python(monkeypatch):
    texts = [None, "", " \t\n\x0b\x0c\r", "One", "one TWO", "a b c", "Ä É a b c d\x1fe f", "x y z " * 500,
             "the quick brown fox jumps over the lazy dog"]
    assert [S.fingerprint(t.encode() if t is not None else None) for t in texts] == [plain_fingerprint(t) for t in texts]
    monkeypatch.setattr(S, "PIECE", 7)  # a long text is counted in pieces
    assert [S.fingerprint((t or "").encode()) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_hash_is_that_of_spark(spark):
    assert spark.sql("SELECT xxhash64('a b c')").first()[0] % 2**64 == next(S.shingle_hashes(b"A b  c"))[0]


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 7])
@pytest.mark.parametrize("held", [3, 1 << 16])
def test_bit_sliced_pairs_equal_all_pairs(monkeypatch, radius, held):
    monkeypatch.setattr(S, "HELD", held)
    fps = np.array(clustered(300, radius), np.uint64)
    first = np.random.default_rng(1).integers(0, 300, 300)
    end = np.minimum(first + np.random.default_rng(2).integers(-5, 200, 300), 300)
    got = {(int(i), int(j)) for a, b in S.close_pairs(fps, first, end, radius) for i, j in zip(a, b)}
    want = {(i, j) for i in range(300) for j in range(first[i], end[i])
            if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
    assert got == want and len(want) > 50


def test_linked_fingerprints_share_a_bucket():
    r = random.Random(3)
    for _ in range(2_000):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), 3):
            y ^= 1 << b
        assert any((x ^ y) & m % 2**64 == 0 for m in S.part_masks())


def test_forest_is_the_components():
    r = random.Random(5)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)]
    label = S.forest(200, iter([tuple(np.array(edges[i:i + 40]).T) for i in range(0, 150, 40)]))
    reach = list(range(200))
    for _ in range(200):
        for a, b in edges:
            reach[a] = reach[b] = min(reach[a], reach[b])
    assert label.tolist() == reach


@pytest.mark.parametrize("tile, broadcast_rows", [(8_192, 1_000_000), (16, 0)])
def test_components_equal_brute_force(spark, tile, broadcast_rows, monkeypatch):
    """Also with buckets of many tiles, without any broadcast but that of hot fingerprints."""
    monkeypatch.setattr(S, "HOT", 3)
    # a common first half makes buckets large
    fps = [(x & 0xFFFFFFFF) | (0xABCDEF01 << 32 if i % 2 else x & ~0xFFFFFFFF) for i, x in enumerate(clustered(500, 9))]
    fps += fps[:7] * 5
    monkeypatch.setattr(S, "fingerprints", lambda docs: docs.select("doc_id", F.col("text").cast("bigint").alias("fp")))
    rows = [(i, str(x - 2**64 if x >> 63 else x)) for i, x in enumerate(fps)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in
           S.near_duplicates(df, tile=tile, broadcast_rows=broadcast_rows).collect()}
    assert got == {i: (f"{x:016x}", c) for i, (x, c) in enumerate(zip(fps, plain_components(fps)))}


def test_query_equals_brute_force(spark):
    rows = S.query(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [plain_fingerprint(d.text) for d in docs]
    want = {d.doc_id: (f"{x:016x}", docs[c].doc_id) for d, x, c in zip(docs, fps, plain_components(fps))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want and len(rows) == len(docs)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = S.near_duplicates(odd_docs).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == odd_docs.count()
    assert by_id[2].component_id == 1 and by_id[1].fingerprint == by_id[2].fingerprint
    assert {by_id[i].fingerprint for i in (4, 5, 6)} == {"0" * 16} and {by_id[i].component_id for i in (4, 5, 6)} == {4}
    assert by_id[7].component_id == 7 and by_id[None].component_id is None
    assert S.near_duplicates(no_docs).isEmpty()
