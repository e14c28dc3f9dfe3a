"""Near-duplicate documents by SimHash fingerprints, compared bit-sliced.

A text's words (A-Z lower-cased) give shingles of three words, repeats included; fewer words give one shingle. Every
shingle has a 64-bit hash, and a bit of the fingerprint is set if it is set in over half of them. Texts whose
fingerprints differ in at most ``RADIUS`` bits are linked, and linked texts form components.

Equal fingerprints are one vertex, so copies are never paired. Fingerprints are cut into ``RADIUS + 2`` parts; two that
are linked agree in at least two parts, so they share one of the buckets that two parts make. A bucket is stored
vertically: one machine word holds one bit of 64 members. A member is compared with 64 others by an XOR for each bit
plane, and carry-save counters of a few words hold the 64 distances; once all 64 exceed the radius the block is
abandoned. Nothing is sampled, and no bucket is cut off.

A bucket of more than ``TILE`` members is dealt into tiles by a hash, and every pair of its tiles is a row of its own, so
no task holds more than two tiles of a bucket. Whatever a task finds it reduces to a forest: at most one link for each
member, however many pairs there are.

Defined cases: a null text, or one without words, has fingerprint zero and is linked like any other; rows that share an
id are each linked by their own fingerprint; a row without an id is linked too but names no component (a component
without any id is null). A text of any length is read whole, its hashes counted in pieces. Repeated rows give rows
each, other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellframe.llm.linking import components
from cellframe.llm.shared import BROADCAST_ROWS, keep, small, table

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
TILE = 8_192
#: Bit planes that are counted before blocks beyond the radius are dropped.
STRIDE = 8
#: Comparisons of a member with a block of 64 that are held at once.
HELD = 1 << 16
#: Hashes of one text that are held at once.
PIECE = 1 << 16
ROWS_AT_ONCE = 256
#: A fingerprint of more rows than this is looked up by broadcast; there are at most rows / HOT of them.
HOT = 100_000


def shingle_hashes(text: bytes, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, in pieces."""
    # bytes.split() splits at exactly the ASCII white space, bytes.lower() changes A-Z alone
    words = text.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), PIECE):
        spans = zip(starts[i:i + PIECE], ends[i:i + PIECE])
        yield np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(text: bytes | None) -> int:
    """The 64 majority bits; zero without words."""
    set_in, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text or b""):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * set_in > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp), a row per row; the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                made = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(made.view(np.int64))], names=["doc_id", "fp"]
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


# --- bit-sliced comparison -----------------------------------------------------------------------


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(blocks, 64): word b of a block holds bit b of its 64 members, member m at bit m."""
    padded = np.zeros(-(-len(fps) // 64) * 64, "<u8")
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(-1, 64, BITS)
    turned = np.ascontiguousarray(bits.transpose(0, 2, 1))
    return np.packbits(turned, axis=2, bitorder="little").view("<u8").reshape(-1, BITS)


def _up_to(bit: np.ndarray) -> np.ndarray:
    """Words whose lowest ``bit`` (0 to 64) bits are set."""
    full = np.uint64(2**64 - 1)
    return np.where(bit <= 0, np.uint64(0), full >> (np.uint64(64) - np.clip(bit, 1, 64).astype(np.uint64)))


def _within(planes: np.ndarray, fps: np.ndarray, block: np.ndarray, alive: np.ndarray, radius: int):
    """Of each fingerprint against each block: which of the members in ``alive`` are within the radius.

    Returns the places in the arguments that have any, and their words. The counters start so that they overflow
    when the distance exceeds the radius.
    """
    places = np.arange(len(fps))
    width = max(1, radius.bit_length())
    start = (1 << width) - 1 - radius
    counters = [np.full(len(fps), np.uint64(2**64 - 1 if start >> w & 1 else 0)) for w in range(width)]
    for first in range(0, BITS, STRIDE):
        over = ~alive
        for b in range(first, first + STRIDE, 2):
            one, two = (
                planes[block, p] ^ (np.uint64(0) - (fps >> np.uint64(p) & np.uint64(1))) for p in (b, b + 1)
            )
            # a full adder takes two planes into the lowest counter, the carry ripples through the others
            half = counters[0] ^ one
            carry = (counters[0] & one) | (half & two)
            counters[0] = half ^ two
            for w in range(1, width):
                counters[w], carry = counters[w] ^ carry, counters[w] & carry
            over |= carry
        alive = alive & ~over
        left = np.flatnonzero(alive)
        if len(left) < len(alive):
            places, fps, block, alive = places[left], fps[left], block[left], alive[left]
            counters = [c[left] for c in counters]
        if not len(left):
            break
    return places, alive


def close_pairs(
    fps: np.ndarray, first: np.ndarray, end: np.ndarray, radius: int = RADIUS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) within the radius, j in [first[i], end[i]), in pieces of bounded size."""
    planes = bit_planes(fps)
    queries = np.flatnonzero(end > first)
    low, high = first[queries] // 64, -(-end[queries] // 64)
    upto = np.cumsum(high - low)
    at = 0
    while at < len(queries):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + HELD, "right")))
        n = high[at:stop] - low[at:stop]
        query = np.repeat(queries[at:stop], n)
        block = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[at:stop], n)
        for i in range(0, len(query), HELD):
            q, b = query[i:i + HELD], block[i:i + HELD]
            alive = _up_to(end[q] - b * 64) & ~_up_to(first[q] - b * 64)
            places, words = _within(planes, fps[q], b, alive, radius)
            bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, member = np.nonzero(bits)
            yield q[places[row]], b[places[row]] * 64 + member
        at = stop


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n members the smallest one that it is connected with."""
    label = np.arange(n)
    for a, b in pairs:
        a, b = label[a], label[b]
        while True:
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                break
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label = label[label]
            a, b = label[a], label[b]
    return label


def _links(fps: np.ndarray, first: np.ndarray, end: np.ndarray, radius: int) -> pa.RecordBatch:
    """The forest of a stretch of members, as (a, b)."""
    label = forest(len(fps), close_pairs(fps, first, end, radius))
    moved = np.flatnonzero(label != np.arange(len(fps)))
    signed = fps.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], names=["a", "b"])


def _link_sorted(radius: int) -> Callable:
    """Takes (key, fp) sorted by key; a bucket may lie across batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def compared(n: int) -> pa.RecordBatch:
            ends = np.append(np.flatnonzero(key[1:n] != key[: n - 1]) + 1, n)
            end = ends[np.searchsorted(ends, np.arange(n), "right")]
            return _links(fps[:n], np.arange(1, n + 1), end, radius)

        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            n = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
            if n:
                yield compared(n)
                key, fps = key[n:], fps[n:]
        if len(key):
            yield compared(len(key))

    return run


def _link_tiles(radius: int) -> Callable:
    """Takes rows of one tile (``two`` is null) or two tiles of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, two = (
                    np.array(batch.column(c)[i].as_py() or [], np.int64).view(np.uint64) for c in ("one", "two")
                )
                fps, n = np.concatenate([one, two]), len(one)
                place = np.arange(len(fps))
                if batch.column("two")[i].is_valid:
                    yield _links(fps, np.full(len(fps), n), np.where(place < n, len(fps), 0), radius)
                else:
                    yield _links(fps, place + 1, np.full(n, n), radius)

    return run


# --- buckets -------------------------------------------------------------------------------------


def part_masks(radius: int = RADIUS) -> list[int]:
    """For each two of ``radius + 2`` parts of a fingerprint, a mask of their bits, as signed longs."""
    cuts = [BITS * i // (radius + 2) for i in range(radius + 3)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (x | y for x, y in combinations(parts, 2))]


def links(classes: DataFrame, radius: int = RADIUS, tile: int = TILE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(a, b): links that connect whatever fingerprints of ``classes`` (fp, distinct) are within the radius."""
    masks = ", ".join(f"named_struct('i', {i}, 'm', {m if m > -2**63 else '-9223372036854775807L - 1'}L)"
                      for i, m in enumerate(part_masks(radius)))
    members = keep(
        classes.selectExpr("fp", f"explode(array({masks})) AS part").selectExpr("xxhash64(part.i, fp & part.m) AS key", "fp")
    )
    large = keep(members.groupBy("key").agg(F.count("fp").alias("n")).where(F.col("n") > tile))
    hot = small(large, broadcast_rows)
    usual = members.join(hot, "key", "left_anti")
    found = usual.repartition("key").sortWithinPartitions("key").mapInArrow(_link_sorted(radius), "a long, b long")
    if large.isEmpty():
        return found
    dealt = members.join(hot, "key").selectExpr("key", "fp", f"CAST(ceil(n / {tile}) AS INT) AS m").selectExpr(
        "key", "fp", "m", "CAST(pmod(xxhash64(fp, 'tile'), m) AS INT) AS t"
    )
    tiles = keep(dealt.groupBy("key", "t").agg(F.collect_list("fp").alias("fps"), F.first("m").alias("m")))
    alone = tiles.selectExpr("fps AS one", "CAST(NULL AS array<bigint>) AS two")
    left = tiles.selectExpr("key", "fps AS one", "explode(sequence(t + 1, t + m)) AS u", "m").where("u < m")
    both = left.join(tiles.selectExpr("key", "t AS u", "fps AS two"), ["key", "u"]).select("one", "two")
    rows = alone.unionByName(both)
    # a row holds up to two tiles of comparisons, so rows are spread evenly, whatever bucket they come from
    spread = rows.repartition(F.xxhash64(F.get("one", F.lit(0)), F.get("two", F.lit(0))))
    return found.unionByName(spread.mapInArrow(_link_tiles(radius), "a long, b long"))


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, tile: int = TILE, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of ``docs`` (doc_id, text), a row per row."""
    made = keep(fingerprints(docs))
    classes = keep(made.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")))
    labels = components(links(classes.select("fp"), radius, tile, broadcast_rows))
    grouped = classes.join(labels.withColumnRenamed("id", "fp"), "fp", "left").where("n > 1 OR label IS NOT NULL")
    grouped = keep(grouped.select("fp", "n", "first", F.coalesce("label", "fp").alias("label")))
    least = grouped.groupBy("label").agg(F.min("first").alias("component"))
    named = keep(grouped.join(small(keep(least), broadcast_rows), "label").select("fp", "n", "component"))
    of = named.select("fp", "component")
    if named.count() <= broadcast_rows:
        found = made.join(F.broadcast(of), "fp", "left")
    else:
        hot = F.broadcast(named.where(F.col("n") > HOT).select("fp", F.col("component").alias("c"), F.lit(True).alias("hot")))
        first = made.join(hot, "fp", "left")
        rest = first.where("hot IS NULL").drop("c", "hot").join(of, "fp", "left")
        found = first.where("hot").select("fp", "doc_id", F.col("c").alias("component")).unionByName(rest)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the table."""
    return near_duplicates(table(spark, sf_dir, "documents"))
