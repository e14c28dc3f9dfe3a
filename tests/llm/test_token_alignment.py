import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cellframe.llm import token_alignment as A

TEXTS = [
    "The quick brown fox", "unbelievable internationalisation", "a  b\n\n\tc ", "naïve café — 中文 😀 x", "<|endoftext|> <s></s> <0x41>",
    "\x00\x1c\x85\xa0 ", "don't we'll I'M", "12345 67,890.00", " leading", "trailing  ", "ééé", "word " * 40, "\n", " ", "x",
    "The quick brown fox", "‮אבג ١٢٣ ﬁ \U0001F469‍\U0001F469",
]


@pytest.fixture(scope="module")
def encoders():
    return A.Encoders(open(A.A_FILE, "rb").read(), open(A.B_FILE, "rb").read())


def plain(texts):
    """The contract, token by token."""
    one = Tokenizer.from_file(A.A_FILE)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=A.B_FILE)
    bytes_of = A.letter_bytes()
    entries = {i: e for e, i in one.get_vocab().items()}

    def spans(ids, spell):
        at, out = 0, []
        for i in ids:
            out.append((at, at := at + len(spell(i)), i))
        return out

    def spell_a(i):
        return bytes(bytes_of[c] for c in entries[i])

    def spell_b(i):
        piece = two.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()

    docs = []
    for text in texts:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        data = (" " + (text or "")).encode()
        if not text or b"".join(map(spell_a, a)) != data or b"".join(map(spell_b, b)) != data:
            docs.append(None)
            continue
        a, b = spans(a, spell_a), spans(b, spell_b)
        links = [(x, y) for s, e, x in a for t, f, y in b if s < f and t < e]
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= cut) for side in (a, b)))
            start = cut
        docs.append((a, b, links, ";".join(groups), len(cuts)))
    counts = Counter(p for d in docs if d for p in set(d[2]))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    return [
        (len(d[0]), len(d[1]), d[4], len(d[2]), sum(counts[p] == best[p[0]] for p in d[2]), sum(counts[p] for p in d[2]),
         hashlib.sha256(d[3].encode()).hexdigest()) if d else (0, 0, 0, 0, 0, 0, "")
        for d in docs
    ]


def rows_of(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in df.collect())


def test_fast_encoder_equals_the_file(encoders):
    r = random.Random(4)
    alphabet = "abcXYZ  \n\t\r.,'\"#0123456789éÀñßÿ×ŒſɏÁ’—…€'s't'll" + "".join(map(chr, range(0xA1, 0x250)))
    texts = ["".join(r.choices(alphabet, k=r.randrange(1, 60))) for _ in range(5_000)] + TEXTS
    full = Tokenizer.from_file(A.A_FILE)
    full.encode_special_tokens = True
    for t in texts:
        assert encoders.ids_a(t).tolist() == full.encode(t, add_special_tokens=False).ids
    assert encoders.fast is not None and sum(A.PLAIN.search(t) is None for t in texts) > 4_000


def test_minimal_perfect_hash():
    r = np.random.default_rng(1)
    pairs = np.unique(r.integers(0, 50_257, 20_000) << A.ID_BITS | r.integers(0, 32_000, 20_000))
    shards = A.shard_of(pairs, 7)
    made = [(s, *A.build(pairs[shards == s])) for s in (0, 2, 3, 6)]
    index, held = A.PairIndex(made, 7), np.isin(shards, (0, 2, 3, 6))
    got = index(pairs)
    assert sorted(got[held]) == list(range(held.sum())) and (got[~held] == -1).all()
    assert (index.pairs[got[held]] == pairs[held]).all()
    assert (index(np.setdiff1d(r.integers(0, 1 << 38, 50_000), pairs)) == -1).all()
    assert (A.PairIndex([], 7)(pairs) == -1).all() and A.PairIndex([(0, *A.build(pairs[:0]))], 1)(pairs).max() == -1
    bits = sum(64 * len(words) for _, _, words, _ in made) / held.sum()
    assert bits < 6


def test_shards_are_the_same_in_sql(spark):
    pairs = [50_256 << A.ID_BITS | 31_999, 0, 1, (1 << 40) - 1, 12_345 << A.ID_BITS | 678]
    df = spark.createDataFrame([(p,) for p in pairs], "pair long").selectExpr(A.shard_sql("pair", 13))
    assert [r[0] for r in df.collect()] == A.shard_of(np.array(pairs), 13).tolist()


@pytest.mark.parametrize("shard_pairs, pass_pairs, partitions", [(1 << 16, 1 << 22, 2), (50, 100, 40)])
def test_equals_plain_alignment(spark, monkeypatch, shard_pairs, pass_pairs, partitions):
    """Also with many shards, several passes, and a tree of more than one level."""
    monkeypatch.setattr(A, "HELD_PAIRS", pass_pairs)
    monkeypatch.setattr(A, "FAN_IN", 4)
    texts = TEXTS + [None, ""] + ["fox " + t for t in TEXTS]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(partitions)
    got = rows_of(A.align(df, shard_pairs=shard_pairs, pass_pairs=pass_pairs))
    assert got == [(i, *w) for i, w in enumerate(plain(texts))]
    assert sum(r[1] > 0 for r in got) >= 30


def test_query_equals_plain_alignment(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    docs = [d for d in docs if len(d.text or "") < 3_000]
    df = spark.createDataFrame([(d.doc_id, d.text) for d in docs], "doc_id long, text string")
    assert rows_of(A.align(df)) == [(d.doc_id, *w) for d, w in zip(docs, plain([d.text for d in docs]))]


def test_odd_rows(odd_docs, no_docs):
    docs = [(r.doc_id if r.doc_id is not None else -1, r.text) for r in odd_docs.collect() if len(r.text or "") < 9_999]
    small = odd_docs.where("coalesce(length(text), 0) < 9999")
    assert rows_of(A.align(small)) == sorted((i, *w) for (i, _), w in zip(docs, plain([t for _, t in docs])))
    long = {r.doc_id: r for r in A.align(odd_docs).collect()}[9]
    assert long.n_a >= 30_000 and long.n_links == long.n_a + long.n_b - long.n_groups
    assert A.align(no_docs).isEmpty()


def test_texts_that_the_tokens_do_not_spell(encoders, monkeypatch):
    spelled = list(encoders.b_bytes)
    spelled[encoders.b.piece_to_id("▁dog")] = b"?"
    monkeypatch.setattr(encoders, "b_bytes", spelled)
    assert [len(ids) for ids in encoders.encode("a dog")] == [0, 0] and len(encoders.encode("a cat")[0])
