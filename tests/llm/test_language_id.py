import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from cellframe.llm import language_id as lid
from cellframe.llm.shared import crc_remainder, table

SF_DIR = "/root/testdata/sf0.01"


def brute_force_bits(train: dict[str, list[str]], text: str) -> dict[str, float]:
    """PPM-C without exclusion, byte by byte from dictionaries."""
    seen = {g: Counter(b for t in ts for b in t.encode()) for g, ts in train.items()}
    shares = Counter()
    for counts in seen.values():
        for b, n in counts.items():
            shares[b] += n / sum(counts.values())
    common = sorted(range(256), key=lambda b: (-shares[b], b))[:63]
    symbol = {b: i for i, b in enumerate(common)}
    out = {}
    for g, texts in train.items():
        tree = defaultdict(Counter)
        for t in texts:
            data = [symbol.get(b, 63) for b in b"\n\n\n" + t.encode()]
            for i in range(3, len(data)):
                for order in range(4):
                    tree[tuple(data[i - order:i])][data[i]] += 1
        rare = {b: seen[g][b] + 1 for b in range(256) if b not in symbol}
        data = b"\n\n\n" + text.encode()
        coded, bits = [symbol.get(b, 63) for b in data], 0.0
        for i in range(3, len(data)):
            for order in range(3, -1, -1):
                counts = tree.get(tuple(coded[i - order:i]))
                if not counts:
                    continue
                total = sum(counts.values()) + len(counts)
                if coded[i] in counts:
                    bits -= math.log2(counts[coded[i]] / total)
                    break
                bits -= math.log2(len(counts) / total)
            else:
                bits += 6
            if coded[i] == 63:
                bits -= math.log2(rare[data[i]] / sum(rare.values()))
        out[g] = bits
    return out


def model_of(train):
    seen = np.array([np.bincount(np.frombuffer("".join(ts).encode(), np.uint8), minlength=256) for ts in train.values()], float)
    symbol_of = lid.symbols(seen)
    windows = [np.unique(np.concatenate([lid._windows(t.encode(), symbol_of) for t in ts]), return_counts=True) for ts in train.values()]
    return lid.Model(list(train), seen, [(a.astype(np.int64), n) for a, n in windows])


def test_code_lengths_equal_a_context_tree_in_dictionaries():
    random.seed(4)
    train = {g: ["".join(random.choices(letters, k=300)) for _ in range(3)] for g, letters in
             {"a": "abcdeé ", "b": "cdefgü ", "c": "xyzabc\n", "d": "qrs ", "e": "mnoß "}.items()}
    model = model_of(train)
    codes, rare = model.codes(), model.rare_codes()
    for text in ["", "abc", "éé cab dü", "QZ!中", "".join(random.choices("abcdxyz qrs", k=200))]:
        got = lid.code_lengths(text, codes, rare, model.symbol_of) / lid.UNIT
        # each byte is rounded to a unit, and one without a symbol of its own twice
        assert np.allclose(got, list(brute_force_bits(train, text).values()), rtol=0, atol=len(text.encode()) / lid.UNIT + 1e-4)


def test_codes_beyond_32_bits_are_whole():
    """Contexts so frequent that each escape costs 18 bits."""
    train = {"a": ["ab" * 250_000], "b": ["abc" * 100]}
    model = model_of(train)
    codes, rare = model.codes(), model.rare_codes()
    for text in ("abab" + "c", "ababQ", "babaabbb"):
        want = list(brute_force_bits(train, text).values())
        got = lid.code_lengths(text, codes, rare, model.symbol_of) / lid.UNIT
        assert np.allclose(got, want, rtol=0, atol=len(text) / lid.UNIT + 1e-3)
    assert (codes[0][1] & np.uint64(0xFFFF)).max() > 70 * lid.UNIT


def test_a_long_text_in_pieces_costs_the_same(monkeypatch):
    model = model_of({"a": ["abc abd abe"], "b": ["xyz xya"]})
    codes, rare = model.codes(), model.rare_codes()
    text = "abc xyz é " * 500
    whole = lid.code_lengths(text, codes, rare, model.symbol_of)
    monkeypatch.setattr(lid, "PIECE", 97)
    assert (lid.code_lengths(text, codes, rare, model.symbol_of) == whole).all()


def test_held_out_accuracy(spark):
    out = lid.query(spark, SF_DIR).join(table(spark, SF_DIR, "documents").select("doc_id", "lang"), "doc_id")
    assert out.where(crc_remainder("doc_id", 3).eqNullSafe(1) != F.col("held_out")).isEmpty()
    row = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a")).first()
    assert row.a > 0.97
    assert out.where("score < 0 OR score > 1 OR score IS NULL").isEmpty()


def test_odd_rows(odd_docs, no_docs):
    model = lid.fit(odd_docs)
    out = lid.predict(odd_docs, model)
    assert out.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    for i in (4, 5, 6):
        assert got[i] == ("und", 0.0)
    assert got[3][0] == "de" and got[1][0] == "en" and got[9][0] == "en"
    assert lid.predict(no_docs, model).isEmpty()
    none = lid.fit(no_docs)
    assert none.langs == [] and {r.lang_pred for r in lid.predict(odd_docs, none).collect()} == {"und"}
