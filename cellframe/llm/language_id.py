"""Language identification by prediction by partial matching (PPM).

For every language a byte context tree of orders 0 to 3 is counted on labelled text and then frozen. A text's code
length under a language is the exact sum, over its bytes, of the PPM code of each byte: in the longest context that has
been seen, a known successor costs ``-log2(n(c, s) / (n(c) + d(c)))`` and anything else the escape code
``-log2(d(c) / (n(c) + d(c)))`` and then its code in the context one byte shorter (method C, without exclusion); below
order 0 all symbols are equally likely. The 63 most frequent bytes are symbols; the other bytes share one symbol, plus
the code of the byte among them. Codes are integers of 1/512 bit, so sums do not depend on the order of work; 16 bits of them
hold 128 bits, more than any code: four escapes from counts below 2^30 and a symbol of six bits.

The language with the shortest code wins (the first name on ties); the score is its posterior under equal priors.

Counting is a Spark job over a bounded sample of the labelled rows; what returns to the driver is at most
``languages * 64^4`` counts, in practice some ten thousand. Each task unfolds the frozen counts into tables of codes
(for four languages, 512 bytes per context seen) and looks every byte of its texts up in them; texts are worked through in pieces of ``PIECE`` bytes.

Defined cases: a null text and one without a letter are ``und`` with score 0; an empty table, or no labelled row, makes
every text ``und``; a null language is not learned from; repeated ids and extra columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellframe.llm.shared import crc_remainder, table

ORDER = 3
BITS = 6
SYMBOLS = 1 << BITS
OTHER = SYMBOLS - 1
#: Contexts of the order below the last.
PARENTS = SYMBOLS ** (ORDER - 1)
UNIT = 512
LANES = 4
EVEN = np.uint64(0x0000FFFF0000FFFF)
#: About so many labelled rows per language are counted, chosen by a hash of their ids, whole texts each.
SAMPLE_PER_LANGUAGE = 3_000
PIECE = 1 << 20
UNDETERMINED = "und"
START = b"\n" * ORDER


def training_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """(lang, text): rows with a language, about ``per_language`` of each, all where there are fewer."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1_000_000))
    share = F.lit(0)
    for lang, n in counts.items():
        most = max(1, round(1_000_000 * min(1.0, per_language / n)))
        share = F.when(F.col("lang") == lang, most).otherwise(share)
    return labelled.where(place < share).select("lang", "text")


def _windows(data: bytes, symbol_of: np.ndarray) -> np.ndarray:
    """For each byte, the symbols of the three bytes before it and its own, as one number."""
    s = symbol_of[np.frombuffer(START + data, np.uint8)].astype(np.uint32)
    return (s[:-3] << 3 * BITS) | (s[1:-2] << 2 * BITS) | (s[2:-1] << BITS) | s[3:]


def _byte_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            counts = total.setdefault(lang, np.zeros(256, np.int64))
            counts += np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "item": at, "n": counts[at]})


def _window_counts(symbol_of: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                windows = np.concatenate([_windows(t.encode("utf-8", "replace"), symbol_of) for t in texts])
                at, n = np.unique(windows, return_counts=True)
                yield pd.DataFrame({"lang": lang, "item": at.astype(np.int64), "n": n.astype(np.int64)})

    return run


class Model:
    """Frozen counts: byte counts and window counts of each language."""

    def __init__(self, langs: list[str], bytes_seen: np.ndarray, windows: list[tuple[np.ndarray, np.ndarray]]):
        self.langs, self.bytes_seen, self.windows = langs, bytes_seen, windows
        self.symbol_of = symbols(bytes_seen)

    def codes(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per four languages, where the codes of each context start, and the code lengths of its 64 symbols.

        Four languages lie side by side in a 64-bit number. A context that none of them has seen shares the codes of the
        context without its first symbol, so the size grows with the contexts seen and not with all there could be.
        """
        tables = []
        for first in range(0, len(self.langs), LANES):
            group = self.windows[first:first + LANES]
            contexts = np.unique(np.concatenate([at >> BITS for at, _ in group]))
            start_of = np.tile(np.arange(PARENTS, dtype=np.int32) << BITS, SYMBOLS)
            start_of[contexts] = (PARENTS + np.arange(len(contexts))) << BITS
            packed = np.zeros(((PARENTS + len(contexts)) << BITS, LANES), np.uint16)
            for lane, (at, n) in enumerate(group):
                parents, own = _code_lengths(at, n, contexts)
                packed[:len(parents), lane] = np.rint(parents * UNIT)
                packed[len(parents):, lane] = np.rint(own * UNIT)
            tables.append((start_of, packed.view("<u8")[:, 0]))
        return tables

    def rare_codes(self) -> np.ndarray:
        """(byte, language) → further code length of a byte without a symbol of its own."""
        rare = self.symbol_of == OTHER
        n = np.where(rare[:, None], self.bytes_seen.T + 1.0, 0)
        out = np.zeros((256, len(self.langs)), np.int64)
        out[rare] = np.rint(-np.log2(n[rare] / n.sum(axis=0)) * UNIT)
        return out


def symbols(bytes_seen: np.ndarray) -> np.ndarray:
    """Byte → symbol: the most frequent bytes of the languages taken together, each language weighing the same."""
    shares = (bytes_seen / np.maximum(bytes_seen.sum(axis=1, keepdims=True), 1)).sum(axis=0)
    order = np.lexsort((np.arange(256), -shares))[:OTHER]
    symbol_of = np.full(256, OTHER, np.uint8)
    symbol_of[order] = np.arange(len(order))
    return symbol_of


def _code_lengths(at: np.ndarray, n: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of every symbol after all contexts below the last order, and after ``contexts`` of the last order.

    ``at`` and ``n`` are one language's counts of windows; ``contexts`` are sorted and hold all that it has seen. A
    context's parent is the context without its first symbol, so codes of the lower order repeat as a block.
    """
    below = np.full(SYMBOLS, float(BITS), np.float32)  # all symbols equally likely
    for order in range(ORDER + 1):
        keys, where = np.unique(at & ((1 << BITS * (order + 1)) - 1), return_inverse=True)
        counts = np.bincount(where, weights=n).astype(np.float64)
        wanted = contexts if order == ORDER else np.arange(SYMBOLS**order)
        row = np.searchsorted(wanted, keys >> BITS)
        seen = np.bincount(row, weights=counts, minlength=len(wanted))
        kinds = np.bincount(row, minlength=len(wanted))
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(kinds > 0, -np.log2(kinds / (seen + kinds)), 0).astype(np.float32)
        parent = below.reshape(-1, SYMBOLS)
        codes = (parent[wanted % len(parent)] + escape[:, None]).reshape(-1)
        codes[(row << BITS) | (keys & OTHER)] = -np.log2(counts / (seen + kinds)[row])
        if order < ORDER:
            below = codes
    return below, codes


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learns from the rows of ``docs`` that have ``text`` and ``lang``."""
    sample = training_sample(docs, per_language)
    schema = "lang string, item long, n long"

    def summed(counted: DataFrame) -> pd.DataFrame:
        return counted.groupBy("lang", "item").agg(F.sum("n").alias("n")).toPandas()

    by_byte = summed(sample.mapInPandas(_byte_counts, schema))
    langs = sorted(by_byte["lang"].unique())
    bytes_seen = np.zeros((len(langs), 256))
    for k, lang in enumerate(langs):
        rows = by_byte[by_byte["lang"] == lang]
        bytes_seen[k, rows["item"]] = rows["n"]
    if not langs:
        return Model([], bytes_seen, [])
    by_window = summed(sample.mapInPandas(_window_counts(symbols(bytes_seen)), schema))
    rows = [by_window[by_window["lang"] == lang].sort_values("item") for lang in langs]
    return Model(langs, bytes_seen, [(r["item"].to_numpy(), r["n"].to_numpy()) for r in rows])


def _lane_sums(packed: np.ndarray) -> np.ndarray:
    """Sums of the four 16-bit lanes."""
    total = np.zeros(LANES, np.int64)
    for start in range(0, len(packed), 1 << 16):  # so many 16-bit numbers fit in a 32-bit sum
        part = packed[start:start + (1 << 16)]
        even, odd = int((part & EVEN).sum()), int(((part >> np.uint64(16)) & EVEN).sum())
        total += [even & 0xFFFFFFFF, odd & 0xFFFFFFFF, even >> 32, odd >> 32]
    return total


def code_lengths(text: str, codes: list[tuple[np.ndarray, np.ndarray]], rare: np.ndarray, symbol_of: np.ndarray) -> np.ndarray:
    """Code length of the whole text under each language, in 1/512 bit."""
    data = text.encode("utf-8", "replace")
    total = np.zeros(rare.shape[1], np.int64)
    for start in range(0, len(data), PIECE):
        before = START if start == 0 else data[start - ORDER:start]
        piece = data[start:start + PIECE]
        windows = _windows(before + piece, symbol_of)[len(before):]
        last = (windows & OTHER).astype(np.int32)
        total += np.concatenate([
            _lane_sums(table.take(start_of.take(windows >> BITS) | last)) for start_of, table in codes
        ])[:len(total)]
        others = np.frombuffer(piece, np.uint8)
        others = others[symbol_of[others] == OTHER]
        if len(others):
            total += rare[others].sum(axis=0)
    return total


def posterior(lengths: np.ndarray) -> tuple[int, float]:
    """The best language and its probability among all, were they equally likely before."""
    best = int(np.argmin(lengths))
    shares = np.exp2(np.maximum(-(lengths - lengths[best]) / UNIT, -1000.0))
    return best, float(shares[best] / shares.sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced)."""
    docs = docs.drop("lang_pred", "score", "_letters")
    spark = docs.sparkSession
    frozen = spark.sparkContext.broadcast((model.langs, model.bytes_seen, model.windows))

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known = Model(*frozen.value)
        codes = rare = None
        for texts, letters in batches:
            if codes is None and known.langs:
                codes, rare = known.codes(), known.rare_codes()
            langs, scores = [], []
            for text, has_letter in zip(texts, letters):
                if codes is None or not has_letter:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                best, score = posterior(code_lengths(text, codes, rare, known.symbol_of))
                langs.append(known.langs[best])
                scores.append(score)
            yield pd.DataFrame({"lang_pred": langs, "score": scores}, columns=["lang_pred", "score"])

    judge = F.pandas_udf(run, "lang_pred string, score double")
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    judged = docs.withColumn("_judged", judge("text", letters))
    return judged.select(*docs.columns, "_judged.lang_pred", "_judged.score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document; a third of them, by the checksum of their id, is not learned from."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 3) == 1
    model = fit(docs.where(~held_out))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )
