"""Benchmark decontamination by the q-gram lemma.

Texts are compared in a normal form: lower case, every run of white space one space, trimmed. An item of m characters
occurs in a document if some stretch of it is within ``k = floor(error_rate * m)`` edits (one character inserted,
deleted or replaced). By the q-gram lemma such a stretch shares at least ``m + 1 - q(k + 1)`` q-grams with the item, all
on diagonals (place in the document minus place in the item) at most 2k apart. So shared q-grams are counted in
diagonal bands 4k wide that overlap by half, which hold any 2k neighbouring diagonals; bands that reach the bound are
kept, and each kept region is aligned in full, within its band, to find the least number of edits.

The items become an index of their q-grams that every task holds: it is broadcast in parts of at most
``ITEM_CHARS`` characters, one pass over the documents per part. The pairs of all parts but the last are written to the
shared folder at once and their broadcasts released, so a benchmark of any size works in bounded memory. A document's q-grams are looked up in pieces that overlap by more than the longest item, whole texts included.

q is chosen per item as the largest of 1 to 8 for which the bound is at least one, so that no occurrence can be missed.

Defined cases: a null or blank text contains nothing; a null or blank item occurs nowhere; repeated items and rows each
give their own pairs; an empty table gives an empty result; an item longer than a document can still occur in it within
its edits. Extra columns are ignored by ``find``, kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellframe.llm.shared import BROADCAST_ROWS, keep, small, table

ERROR_RATE = 0.1
Q = 8
PIECE = 1 << 18
ITEM_CHARS = 4_000_000
FILTER_BITS = 22
#: Shared places counted at once, of some 150 bytes each.
SLICE = 1 << 18
#: A pair of an item and a band is one number: the band, from this one on, in its lower 40 bits.
_ZERO_BAND = 1 << 38
_BAND_BITS = (1 << 40) - 1
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """Each q-gram as a 64-bit number. Characters share numbers of 8 bits, which can only add candidates."""
    letters = ((points * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    padded = letters.tobytes() + bytes(8)
    windows = np.ndarray(n, "<u8", padded, strides=(1,))  # eight letters from each place on
    return windows & np.uint64((1 << 8 * q) - 1)


def edits_allowed(m: int, error_rate: float) -> int:
    return int(error_rate * m)


def gram_size(m: int, k: int) -> int:
    return max(1, min(Q, m // (k + 1)))


class Index:
    """The q-grams of items, one sorted list per q, with a bitmap in front."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.ids = [None if i is None else str(i) for i, _ in items]
        self.texts = [t for _, t in items]
        self.points = [code_points(t) for t in self.texts]
        self.k = np.array([edits_allowed(len(p), error_rate) for p in self.points])
        self.m = np.array([len(p) for p in self.points])
        self.longest = int(self.m.max()) if len(items) else 0
        self.by_q = {}
        q_of = [gram_size(m, k) for m, k in zip(self.m, self.k)]
        self.bound = np.array([m + 1 - q * (k + 1) for m, k, q in zip(self.m, self.k, q_of)])
        for q in sorted(set(q_of)):
            chosen = [i for i, x in enumerate(q_of) if x == q]
            found = [grams(self.points[i], q) for i in chosen]
            gram = np.concatenate(found)
            item = np.repeat(np.array(chosen), [len(f) for f in found])
            place = np.concatenate([np.arange(len(f)) for f in found])
            order = np.argsort(gram, kind="stable")
            gram, item, place = gram[order], item[order], place[order]
            bitmap = np.zeros(1 << FILTER_BITS, bool)
            bitmap[(gram * _SPREAD) >> np.uint64(64 - FILTER_BITS)] = True
            keys, first, count = np.unique(gram, return_index=True, return_counts=True)
            self.by_q[q] = keys, first, count, item, place, bitmap

    def regions(self, points: np.ndarray) -> Iterator[np.ndarray]:
        """Rows (item, band) that reach their bound, each once; band d holds diagonals 2kd to 2kd + 4k (2 where k is 0).

        Places that share q-grams are gone through in the order of the text, ``SLICE`` of them at a time. Between slices
        only the counts of bands that the text has not yet passed are kept, so memory does not grow with the repeats of a
        q-gram in the text or in the items.
        """
        for q, (keys, first, count, item, place, bitmap) in self.by_q.items():
            found = grams(points, q)
            at = np.flatnonzero(bitmap[(found * _SPREAD) >> np.uint64(64 - FILTER_BITS)])
            slot = np.searchsorted(keys, found[at])
            same = keys[np.minimum(slot, len(keys) - 1)] == found[at]
            at, slot = at[same], slot[same]
            ends = np.cumsum(count[slot])
            starts = ends - count[slot]
            open_pair, open_size = np.zeros(0, np.int64), np.zeros(0, np.int64)
            total = int(ends[-1]) if len(ends) else 0
            for low in range(0, total, SLICE):
                high = min(low + SLICE, total)
                one, last = np.searchsorted(ends, [low, high - 1], "right")
                n = np.minimum(ends[one:last + 1], high) - np.maximum(starts[one:last + 1], low)
                which = np.repeat(np.arange(one, last + 1), n)
                hit = first[slot[which]] + np.arange(low, high) - starts[which]
                items = item[hit]
                band = (at[which] - place[hit]) // np.maximum(2 * self.k[items], 1) + _ZERO_BAND
                pair, size = np.unique(
                    np.concatenate([items << 40 | band, items << 40 | (band - 1)]), return_counts=True
                )
                before = np.zeros(len(pair), np.int64)
                known = np.searchsorted(pair, open_pair)
                again = pair[np.minimum(known, len(pair) - 1)] == open_pair
                before[known[again]] = open_size[again]
                size = size + before
                bound = self.bound[pair >> 40]
                reached = pair[(size >= bound) & (before < bound)]
                if len(reached):
                    yield np.stack([reached >> 40, (reached & _BAND_BITS) - _ZERO_BAND], 1)
                pair, size = np.concatenate([pair, open_pair[~again]]), np.concatenate([size, open_size[~again]])
                # a band's last place is its last diagonal at the item's end
                items, band = pair >> 40, (pair & _BAND_BITS) - _ZERO_BAND
                going = (band + 2) * np.maximum(2 * self.k[items], 1) + self.m[items] > at[last]
                open_pair, open_size = pair[going], size[going]

    def best(self, text: str, points: np.ndarray, i: int, band: int) -> tuple[int, int] | None:
        """(edits, end) of the best alignment of the item within the band's diagonals, if it is near enough."""
        k, m = int(self.k[i]), int(self.m[i])
        step = max(2 * k, 1)
        # an alignment that touches the band may leave it by at most k diagonals
        low, high = band * step - k, band * step + 2 * step + k
        exact = text.find(self.texts[i], max(0, low), max(0, high + m))
        return (0, exact + m) if exact >= 0 else align(self.points[i], points, low, high, k)


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int] | None:
    """Least edits between ``item`` and a stretch of ``text`` on diagonals low to high, and where the stretch ends.

    Beyond its ends the text is filled with a character that equals none: to replace it costs what it costs to delete
    the item's character instead, so no alignment gets cheaper. ``row`` holds, per diagonal, the edits less the
    diagonal's number, so that text the item lacks is a running minimum.
    """
    width, m = high - low + 1, len(item)
    steps = np.arange(width, dtype=np.int32)
    first, last = max(0, low), max(0, min(len(text), high + m))
    region = np.full(width + m - 1, 0xFFFFFFFF, np.uint32)
    region[first - low:last - low] = text[first:last]
    row = -steps
    for i, c in enumerate(item.tolist()):
        new = row + (region[i:i + width] != c)
        np.minimum(new[:-1], row[1:] + 2, out=new[:-1])  # a character of the item that the text lacks
        row = np.minimum.accumulate(new)  # characters of the text that the item lacks
        if i % 16 == 15 and (row + steps).min() > k:
            return None
    row = row + steps
    best = int(row.argmin())
    return (int(row[best]), min(max(low + best + m, 0), len(text))) if row[best] <= k else None


def find(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """(doc_id, item_id, edits, end): each pair of a document and an item that occurs in it, with its best occurrence.

    ``docs`` has doc_id and text, ``items`` item_id and text; ``end`` counts characters of the normal form. Only an
    item's best occurrence per document is returned, the first of equals.
    """
    if not 0 <= error_rate < 0.5:
        raise ValueError("error_rate must be at least 0 and below 0.5")
    # ids go as text: pandas would make floating point numbers of a column with nulls
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    spark = docs.sparkSession
    parts = item_parts(items)
    part, written = next(parts, None), []
    if part is None:
        return spark.createDataFrame([], "doc_id long, item_id long, edits int, end long")
    for following in parts:
        held = spark.sparkContext.broadcast(part)
        written.append(keep(_find(docs, held, error_rate)))
        held.destroy()
        part = following
    found = _find(docs, spark.sparkContext.broadcast(part), error_rate)
    for passed in written:
        found = found.unionByName(passed)
    return found


def item_parts(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in normal form, in lists of at most ``ITEM_CHARS`` characters (or one item)."""
    part, size = [], 0
    for row in items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").toLocalIterator():
        text = normal(row.text)
        if not text:
            continue
        if part and size + len(text) > ITEM_CHARS:
            yield part
            part, size = [], 0
        part.append((row.item_id, text))
        size += len(text)
    if part:
        yield part


def _find(docs: DataFrame, items, error_rate: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(items.value, error_rate)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"].array, batch["text"]):
                for i, (edits, end) in occurrences(normal(text), index).items():
                    rows.append((doc, index.ids[i], edits, end))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "edits", "end"])

    found = docs.mapInPandas(run, "doc_id string, item_id string, edits int, end long")
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("doc_id", "item_id")})


def occurrences(text: str, index: Index) -> dict[int, tuple[int, int]]:
    """Item → (edits, end) of its best occurrence; a long text goes by in overlapping pieces."""
    best: dict[int, tuple[int, int]] = {}
    overlap = 2 * index.longest
    for start in range(0, max(1, len(text) - overlap), PIECE):
        piece = text[start:start + PIECE + overlap]
        points = code_points(piece)
        for reached in index.regions(points):
            for i, band in reached.tolist():
                got = index.best(piece, points, i, band)
                if got is not None:
                    got = (got[0], got[1] + start)
                    best[i] = min(best.get(i, got), got)
    return best


def clean(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE,
          broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` without the documents in which an item occurs; a document without an id stays."""
    leaking = keep(find(docs, items, error_rate).where("doc_id IS NOT NULL").select("doc_id").distinct())
    return docs.join(small(leaking, broadcast_rows), "doc_id", "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
