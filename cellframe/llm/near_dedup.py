"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles becomes ``REGISTERS`` registers: each keeps ``floor(1 - log_b x)`` of the smallest of
exponentially distributed hashes x of its shingles, cut off to 16 bits. Registers of a union are the larger registers,
and two sets agree in a register about as often as their Jaccard similarity J. Bands of registers are buckets;
candidates are kept if the likelihood of how many registers are larger, smaller and equal, given both set sizes, peaks
not far below the threshold; then both whole sets are compared.

32 bands of 4 registers miss a pair of similarity 0.8 with probability (1 - 0.8^4)^32 < 1e-7; the likelihood bound lies
five standard deviations below the threshold. Documents with equal sets are one vertex, so copies are never paired.

Defined cases: without words (or text) the set is empty and links with nothing; fewer words than a shingle has make one
shingle; words are lower-cased A-Z only. A null id links with nothing, has a null component and is kept. Rows that
share an id are one vertex if their sets are equal, else each is linked on its own and all get the smallest component
found for the id. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellframe.llm.linking import link
from cellframe.llm.shared import BROADCAST_ROWS, keep, small, table

REGISTERS = 128
ROWS = 4
BASE = 1.001
TOP = 65_535
SIGMAS = 5
#: Registers also go by their last four bits, sixteen to a word, which compares many pairs fast.
LANES = 16
#: Bits of the parity sketch of a set: where two differ, their sets differ in at least one shingle.
PARITY_BITS = 2_048
WORD_CACHE = 200_000
CHUNK = 512

_random = np.random.default_rng(20240229)
MULTIPLY = _random.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _random.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self, size: int):
        self.size, self.seen = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.split() splits at exactly the ASCII white space, bytes.lower() changes A-Z alone
        found = (text or "").encode("utf-8", "replace").lower().split()
        if len(self.seen) > WORD_CACHE:
            self.seen.clear()
        seen, digest, hashes = self.seen, xxhash.xxh3_64_intdigest, np.empty(len(found), np.uint64)
        for i, word in enumerate(found):
            h = seen.get(word)
            if h is None:
                h = seen[word] = digest(word)
            hashes[i] = h
        n = max(1, len(found) - self.size + 1) if len(found) else 0
        out = np.full(n, min(self.size, len(found)), np.uint64)
        for j in range(min(self.size, len(found))):
            out = _mixed(out * MIX + hashes[j:j + n])
        return np.unique(out)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a set of well mixed hashes."""
    least = np.full(REGISTERS, np.uint64(2**64 - 1))
    for start in range(0, len(shingles), CHUNK):
        some = shingles[start:start + CHUNK]
        np.minimum(least, (MULTIPLY[:, None] * some[None, :] + ADD[:, None]).min(axis=1), out=least)
    u = (least >> np.uint64(11)).astype(np.float64) / 2**53 + 2.0**-54
    exponential = -np.log1p(-u)
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)) + TOP // 4, 0, TOP).astype(np.uint16)


def low_bits(sketch: np.ndarray) -> np.ndarray:
    lanes = (sketch & np.uint16(15)).astype(np.uint64).reshape(-1, LANES)
    return (lanes << (np.arange(LANES, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each bit, as 64-bit words."""
    odd = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, sketch, low, odd), a row per row.

    Set size, a 128-bit name of the set, its registers, their last bits, and its parity sketch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Shingler(shingle)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                s = of(text)
                a = xxhash.xxh3_128_intdigest(s.tobytes())
                sketch = registers(s) if len(s) else np.zeros(0, np.uint16)
                rows.append((len(s), (a >> 64) - 2**63, (a & (2**64 - 1)) - 2**63,
                             sketch.astype(">u2").tobytes(), low_bits(sketch), parities(s)))
            out = pd.DataFrame(rows, columns=["n_shingles", "f1", "f2", "sketch", "low", "odd"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    # ids go as text: pandas would make floating point numbers of a column with nulls
    made = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        run, "doc_id string, n_shingles long, f1 long, f2 long, sketch binary, low array<long>, odd array<long>"
    )
    return made.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles): the whole sets, as sorted hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Shingler(shingle)
        for batch in batches:
            yield pd.DataFrame({"id": batch["doc_id"], "shingles": [of(t).view(np.int64) for t in batch["text"]]})

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(
        run, "id long, shingles array<long>"
    )


def likelihood_peak(x: str, y: str) -> str:
    """SQL: the similarity that makes the numbers of larger, smaller and equal registers most likely, given both sizes.

    With u and v the shares of both sizes in their sum, a register is larger in x with probability u - vJ, in y with
    v - uJ, and equal with J (for bases near 1); the derivative of the likelihood is zero at a root of a quadratic.
    """
    u, v, m = f"({x}.n / ({x}.n + {y}.n))", f"({y}.n / ({x}.n + {y}.n))", float(REGISTERS)
    b = f"(s.e * ({u} * {u} + {v} * {v}) + s.g * {v} * {v} + ({m}D - s.e - s.g) * {u} * {u})"
    root = f"sqrt(greatest(0D, {b} * {b} - 4 * {m}D * {u} * {u} * {v} * {v} * s.e))"
    at = "substring({}.sketch, 2 * i + 1, 2)"
    one, two = at.format(x), at.format(y)
    return (
        f"aggregate(sequence(0, {REGISTERS - 1}), named_struct('e', 0, 'g', 0), (s, i) -> named_struct("
        f"'e', s.e + if({one} = {two}, 1, 0), 'g', s.g + if({one} > {two}, 1, 0)), "
        f"s -> ({b} - {root}) / (2 * {m}D * {u} * {v}))"
    )


def differing(x: str, y: str) -> str:
    """SQL: in how many registers the last four bits differ. Plain arithmetic on longs, so it is compiled."""
    words = []
    for i in range(REGISTERS // LANES):
        apart = f"({x}.low[{i}] ^ {y}.low[{i}])"
        pairs = f"({apart} | shiftrightunsigned({apart}, 1))"
        words.append(f"bit_count(({pairs} | shiftrightunsigned({pairs}, 2)) & {0x1111111111111111}L)")
    return "(" + " + ".join(words) + ")"


def odd_bits(x: str, y: str) -> str:
    """SQL: in how many bits the parity sketches differ, never more than the shingles that only one set has."""
    return "(" + " + ".join(f"bit_count({x}.odd[{i}] ^ {y}.odd[{i}])" for i in range(PARITY_BITS // 64)) + ")"


def near(percent: int):
    """What every pair of that similarity fulfils, but for one in a million: like sizes, parity sketches that leave
    room for it, few differing registers, and a likelihood that does not peak far below.

    The first two hold for every such pair, and dispose of most others in a few instructions.
    """
    goal = percent / 100
    bound = goal - SIGMAS * (goal * (1 - goal) / REGISTERS) ** 0.5
    miss = (1 - goal) * (1 - 2.0**-4)
    most = REGISTERS * miss + SIGMAS * (REGISTERS * miss * (1 - miss)) ** 0.5

    def holds(x: str, y: str) -> Column:
        sizes = f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)"
        room = f"{100 + percent} * {odd_bits(x, y)} <= {100 - percent} * ({x}.n + {y}.n)"
        few = f"{differing(x, y)} <= {int(most) + 1}"
        return F.expr(f"{sizes} AND {room} AND {few} AND {likelihood_peak(x, y)} >= {bound}D")

    return holds


def buckets(classes: DataFrame) -> DataFrame:
    """(key, id): one row per band of each sketch."""
    bands, width = REGISTERS // ROWS, 2 * ROWS
    return classes.select("id", "sketch", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")).select(
        F.expr(f"xxhash64(band, substring(sketch, {width} * band + 1, {width}))").alias("key"), "id"
    )


def verifier(docs: DataFrame, shingle: int, percent: int, broadcast_rows: int):
    """Compares whole sets; they are made again for the texts that have candidates only."""

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = keep(pairs.select("a", "b").distinct())
        ids = keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
        wanted = small(ids.withColumnRenamed("id", "doc_id"), broadcast_rows)
        found = keep(sets(docs.join(wanted, "doc_id", "left_semi"), shingle))
        for end in ("a", "b"):
            pairs = pairs.join(found.select(F.col("id").alias(end), F.col("shingles").alias(f"of_{end}")), end)
        both = "size(array_intersect(of_a, of_b))"
        return pairs.where(
            F.expr(f"100L * {both} >= {percent}L * (size(of_a) + size(of_b) - {both})")
        )

    return verify


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of ``docs`` (doc_id, text), a row per row.

    The ids of texts that have candidates are broadcast only if there are at most ``broadcast_rows``.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = keep(sketches(docs, shingle))
    name = ["f1", "f2", "n_shingles"]
    classes = keep(
        made.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*name)
        .agg(F.min("doc_id").alias("id"), F.first("sketch").alias("sketch"), F.first("low").alias("low"),
             F.first("odd").alias("odd"))
    )
    sketched = classes.select("id", F.col("n_shingles").alias("n"), "sketch", "low", "odd")
    labels = link(
        buckets(classes), lambda ids: sketched.join(ids, "id", "left_semi"), near(percent),
        verifier(docs, shingle, percent, broadcast_rows),
    )
    named = classes.join(labels, "id", "left").select(*name, F.coalesce("label", "id").alias("found"))
    of = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return made.drop("sketch", "low", "odd").join(named, name, "left").select(
        "doc_id", "n_shingles", of.alias("component_id"), F.col("doc_id").eqNullSafe(of).alias("kept")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, by its pairs of neighbouring words."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
