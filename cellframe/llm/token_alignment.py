"""How the tokens of two tokenizers cover each other, with corpus counts behind a minimal perfect hash.

A blank and the text are encoded by A (a byte-level BPE file), the text by B (a piece model, which adds the blank itself).
Both token sequences spell the same bytes, so they are aligned by offsets: where a token of A and one of B end together
a group ends, and a token of A is linked with every token of B whose byte range overlaps its own. A pair of ids counts the
documents that hold it linked.

* Texts are encoded once, and the ids kept as a table; later passes align them again, which takes a few array operations.
* The distinct pairs of the corpus are dealt into shards of about ``SHARD_PAIRS`` by arithmetic on their ids. A task builds
  a minimal perfect hash of each shard: level by level a bit array marks the places that exactly one pair falls on, the
  others go on, and the rank of its bit is a pair's index. Pairs lie in that order, so a looked-up pair is verified.
* Every task counts its documents in one dense vector per shard; the vectors are summed up a tree of tasks.
* A second pass over the ids looks up each link's count, and whether it is the highest of its A id.

Shards are used ``PASS_PAIRS`` pairs at a time. What a pass broadcasts (pairs, bit arrays, counts) and what of it passes
the driver is bounded by that, and the highest counts by the vocabulary of A; more pairs make more passes over the ids.

Defined cases: a null or empty text, or one whose tokens of A or B do not spell it, has no tokens: all numbers are zero and
``groups_sha256`` is empty. Special tokens' strings are plain text. Every row is a document, repeated rows and rows without
an id included. Texts of any length are encoded whole. Other columns are ignored; an empty table gives an empty result.

The files of both tokenizers are read where the job is started and travel with it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellframe.llm.shared import keep, table

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: How byte-level BPE cuts a text into words before it merges.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Letters, digits and white space are the same in all releases of Unicode as far as this; other texts take the slower encoder.
PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ‐-…€]")
ID_BITS = 20
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "a", "b"]
SHARD_PAIRS = 1 << 16
PASS_PAIRS = 1 << 22
#: Places in a bit array for each pair that is left.
ROOM = 3
FAN_IN = 16
ROWS_AT_ONCE = 128
#: A task hands on the distinct pairs it has seen when it holds so many.
HELD_PAIRS = 1 << 21


def letter_bytes() -> dict[str, int]:
    """The character by which byte-level BPE files write each byte: itself if visible, else the next from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoders:
    """Texts to the ids of both tokenizers and their groups, and ids to bytes."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        import tiktoken

        self.a_file, self.full = a_file, None
        read = json.loads(a_file)
        vocabulary, byte_of = read["model"]["vocab"], letter_bytes()
        spelled = {i: bytes(byte_of[c] for c in entry) for entry, i in vocabulary.items()}
        spelled |= {t["id"]: t["content"].encode() for t in read["added_tokens"]}
        self.a_bytes = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        # merges in the order of the ids they make are ranks, by which an equal and faster encoder merges
        merges = [m if isinstance(m, list) else m.split(" ") for m in read["model"]["merges"]]
        ids = [vocabulary[x + y] for x, y in merges]
        made = {*ids, *(i for c, i in vocabulary.items() if len(c) == 1)}
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        in_words = read["normalizer"] is None and usual.items() <= (read["pre_tokenizer"] or {}).items()
        self.fast = None
        if in_words and ids == sorted(ids) and made >= set(vocabulary.values()):
            self.fast = tiktoken.Encoding(
                "a", pat_str=PATTERN, mergeable_ranks={self.a_bytes[i]: i for i in made}, special_tokens={}
            )
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.IsByte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.b.IdToPiece(i) for i in range(self.b.GetPieceSize()))
        ]
        self.types = id_types(len(self.a_bytes), len(self.b_bytes))
        self.sizes = tuple(np.array([len(t) for t in spelled], np.int64) for spelled in (self.a_bytes, self.b_bytes))

    def ids_a(self, text: str) -> np.ndarray:
        if self.fast is not None and not PLAIN.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        if self.full is None:
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_str(self.a_file.decode())
            self.full.encode_special_tokens = True
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Both sequences, empty if either does not spell a blank and the text."""
        if text:
            a, b = self.ids_a(" " + text), self.b.encode(text, num_threads=1)
            data = (" " + text).encode("utf-8", "replace")
            if spells(self.a_bytes, a.tolist(), data) and spells(self.b_bytes, b, data):
                return a.astype(self.types[0]), np.array(b, self.types[1])
        return np.zeros(0, self.types[0]), np.zeros(0, self.types[1])


def spells(token_bytes: list[bytes], ids: list[int], data: bytes) -> bool:
    return b"".join(map(token_bytes.__getitem__, ids)) == data


def id_types(n_a: int, n_b: int) -> list[str]:
    """How the ids of both vocabularies are written."""
    return ["<u2" if n <= 1 << 16 else "<u4" for n in (n_a, n_b)]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all tokens whose byte ranges overlap, in order. Both sequences end at the same byte."""
    starts_a, starts_b = (np.concatenate([[0], e[:-1]]) if len(e) else e for e in (ends_a, ends_b))
    low, high = np.searchsorted(ends_b, starts_a, "right"), np.searchsorted(starts_b, ends_a, "left")
    n = high - low
    i = np.repeat(np.arange(len(ends_a)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


class GroupText:
    """The groups of a document as ``a1,a2|b1;a3|b2,b3``, out of a table of all ids with what may follow them."""

    def __init__(self, n_a: int, n_b: int):
        self.first_b = 2 * n_a
        written = np.array([f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, ",;")) for i in range(n) for end in ends], "S")
        self.bytes = written.view(np.uint8).reshape(len(written), -1)

    def __call__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[int, bytes]:
        last_a = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a
        last_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
        group_a, group_b = (np.cumsum(last) - last for last in (last_a, last_b))
        # in the order of groups, all tokens of A before those of B
        before_b = np.searchsorted(group_a, group_b, "right")
        place_b = before_b + np.arange(len(b))
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
        codes = np.empty(len(a) + len(b), np.int64)
        codes[place_a] = 2 * a.astype(np.int64) + last_a
        codes[place_b] = 2 * b.astype(np.int64) + last_b + self.first_b
        written = self.bytes[codes]
        return int(last_a.sum()), written[written > 0].tobytes()[:-1]


def encoded(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, a, b), a row per row; nothing counted yet."""
    files = []
    for path in (a_file, b_file):
        with open(path, "rb") as file:
            files.append(file.read())
    shipped = docs.sparkSession.sparkContext.broadcast(tuple(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(*shipped.value)
        if max(len(encoders.a_bytes), len(encoders.b_bytes)) > 1 << ID_BITS:
            raise ValueError(f"ids must stay below 2^{ID_BITS}")
        group_text = GroupText(len(encoders.a_bytes), len(encoders.b_bytes))
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                rows = []
                for text in part.column("text").to_pylist():
                    a, b = encoders.encode(text)
                    if not len(a):
                        rows.append((0, 0, 0, 0, 0, 0, "", b"", b""))
                        continue
                    n_groups, written = group_text(a, b, np.cumsum(encoders.sizes[0][a]), np.cumsum(encoders.sizes[1][b]))
                    # each end in only one of the sequences makes one more overlap
                    n_links = len(a) + len(b) - n_groups
                    name = hashlib.sha256(written).hexdigest()
                    rows.append((len(a), len(b), n_groups, n_links, 0, 0, name, a.tobytes(), b.tobytes()))
                types = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=COLUMNS)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string, a binary, b binary"
    )


def ids_of(part: pa.RecordBatch, column: str, kind: str) -> np.ndarray:
    """The ids of all rows, one after another."""
    values = part.column(column)
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset: values.offset + len(values) + 1]
    data = values.buffers()[2]
    return np.frombuffer(data if data is not None else b"", np.uint8)[offsets[0]: offsets[-1]].view(kind)


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values in order, by sorting, which is faster here than what np.unique does."""
    values = np.sort(values)
    return values[np.diff(values, prepend=values[:1] - 1) != 0]


def linked(part: pa.RecordBatch, sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, pair) of all links of a few documents; a pair is ``a << ID_BITS | b``.

    The documents are laid end to end: all sequences end together, so no link crosses from one to the next.
    """
    a, b = (ids_of(part, c, t) for c, t in zip("ab", id_types(len(sizes_a), len(sizes_b))))
    i, j = overlaps(np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b]))
    row = np.repeat(np.arange(part.num_rows), part.column("n_a").to_numpy())
    return row[i], a[i].astype(np.int64) << ID_BITS | b[j]


# --- pairs and their minimal perfect hash -----------------------------------------------------------


def shard_sql(pair: str, n: int) -> str:
    a, b = f"shiftright({pair}, {ID_BITS})", f"({pair} & {(1 << ID_BITS) - 1})"
    mixed = f"(shiftright({a} * 2654435761L + {b} * 2246822519L, 15) & {(1 << 24) - 1})"
    return f"CAST(shiftright({mixed} * {n}, 24) AS INT)"


def shard_of(pairs: np.ndarray, n: int) -> np.ndarray:
    a, b = pairs >> ID_BITS, pairs & ((1 << ID_BITS) - 1)
    return (a * 2654435761 + b * 2246822519 >> 15 & (1 << 24) - 1) * n >> 24


def _mixed(pairs: np.ndarray, level: int) -> np.ndarray:
    x = pairs.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x >> np.uint64(32)


def _place(pairs: np.ndarray, level: int, room: np.ndarray | int) -> np.ndarray:
    return (_mixed(pairs, level) * np.asarray(room, np.uint64) >> np.uint64(32)).astype(np.int64)


def build(pairs: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The sizes of the levels, all bits in words, and the pairs by their index."""
    sizes, words, ordered, left = [], [], [], distinct(pairs)
    while len(left):
        room = -(-int(len(left) * ROOM + 1) // 64) * 64
        place = _place(left, len(sizes), room)
        alone = np.bincount(place, minlength=room) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        settled = alone[place]
        ordered.append(left[settled][np.argsort(place[settled])])
        sizes.append(room)
        left = left[~settled]
    empty = np.zeros(0, np.int64)
    return sizes, np.concatenate(words or [empty.view("<u8")]), np.concatenate(ordered or [empty])


class PairIndex:
    """The functions of some shards as one: a pair to its index, shard after shard, or -1 for any other pair."""

    def __init__(self, shards: list[tuple[int, list[int], np.ndarray, np.ndarray]], n_shards: int):
        self.n_shards = n_shards
        self.words = np.concatenate([np.zeros(0, "<u8"), *(w for _, _, w, _ in shards)])
        self.pairs = np.concatenate([np.zeros(0, np.int64), *(p for *_, p in shards)])
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.first = {s: sum(len(p) for *_, p in shards[:k]) for k, (s, *_) in enumerate(shards)}
        depth = max((len(sizes) for _, sizes, _, _ in shards), default=0)
        self.rooms = np.zeros((depth, n_shards), np.int64)
        self.starts = np.zeros((depth, n_shards), np.int64)
        at = 0
        for shard, sizes, words, _ in shards:
            self.rooms[: len(sizes), shard] = sizes
            self.starts[: len(sizes), shard] = at * 64 + np.cumsum([0, *sizes[:-1]])
            at += len(words)

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        found, shard, open_ = np.full(len(pairs), -1), shard_of(pairs, self.n_shards), None
        some, of = pairs, shard
        for level in range(len(self.rooms)):
            at = self.starts[level][of] + _place(some, level, self.rooms[level][of])
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            rank = self.before[at >> 6] + below
            if open_ is None:
                found[hit], open_ = rank[hit], np.flatnonzero(~hit)
            else:
                found[open_[hit]], open_ = rank[hit], open_[~hit]
            of = shard[open_]
            if level + 1 < len(self.rooms):
                open_ = open_[self.rooms[level + 1][of] > 0]
            if not len(open_):
                break
            some, of = pairs[open_], shard[open_]
        known = found >= 0
        known[known] = self.pairs[found[known]] == pairs[known]
        return np.where(known, found, -1)


def distinct_pairs(rows: DataFrame, sizes) -> DataFrame:
    """(pair) of all links of the corpus, made distinct in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for batch in batches:
            new = [held]
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                new.append(distinct(linked(batch.slice(first, ROWS_AT_ONCE), *sizes.value)[1]))
            held = distinct(np.concatenate(new))
            if len(held) > HELD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(held)], names=["pair"])
                held = held[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held)], names=["pair"])

    return rows.select("n_a", "a", "b").mapInArrow(run, "pair long").distinct()


def functions_of(pairs: DataFrame, n_shards: int) -> DataFrame:
    """(shard, sizes, words, pairs): a minimal perfect hash for each shard."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sizes, words, ordered = build(frame["pair"].to_numpy())
        return pd.DataFrame(
            {"shard": [int(frame["shard"].iloc[0])], "sizes": [sizes],
             "words": [words.astype("<u8").tobytes()], "pairs": [ordered.astype("<i8").tobytes()]}
        )

    sharded = pairs.selectExpr("pair", f"{shard_sql('pair', n_shards)} AS shard")
    return sharded.groupBy("shard").applyInPandas(run, "shard int, sizes array<long>, words binary, pairs binary")


def counted(rows: DataFrame, sizes, index) -> DataFrame:
    """(node, shard, counts): each task's dense vectors of the shards that it has documents for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = index.value
        counts = np.zeros(len(of.pairs), np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                row, pair = linked(batch.slice(first, ROWS_AT_ONCE), *sizes.value)
                once = distinct(row << 2 * ID_BITS | pair)  # a document counts once for a pair
                at = of(once & ((1 << 2 * ID_BITS) - 1))
                counts += np.bincount(at[at >= 0], minlength=len(counts))
        node = TaskContext.get().partitionId()
        cuts = [*of.first.values(), len(counts)]
        for shard, a, b in zip(of.first, cuts, cuts[1:]):
            if counts[a:b].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node], pa.int32()), pa.array([shard], pa.int32()),
                     pa.array([counts[a:b].astype("<i8").tobytes()])], names=["node", "shard", "counts"],
                )

    return rows.select("n_a", "a", "b").mapInArrow(run, "node int, shard int, counts binary")


def tree_sum(vectors: DataFrame) -> DataFrame:
    """One vector per shard: ``FAN_IN`` neighbours are added at a time, so no task holds more, however many tasks counted."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, "<i8") for c in frame["counts"])
        return pd.DataFrame({"node": [int(frame["node"].iloc[0]) // FAN_IN], "shard": [int(frame["shard"].iloc[0])],
                             "counts": [total.tobytes()]})

    vectors = keep(vectors)
    last = vectors.agg(F.max("node")).first()[0] or 0
    while last:
        parent = F.floor(F.col("node") / FAN_IN).alias("parent")
        vectors = vectors.groupBy("shard", parent).applyInPandas(run, vectors.schema)
        last //= FAN_IN
    return vectors


def highest_counts(functions: DataFrame, totals: DataFrame) -> DataFrame:
    """(a, most): the highest count of each A id, a row per shard and id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pairs, counts in zip(batch["pairs"], batch["counts"]):
                a = np.frombuffer(pairs, "<i8") >> ID_BITS
                yield pd.DataFrame({"a": a, "most": np.frombuffer(counts, "<i8")}).groupby("a", as_index=False).max()

    both = functions.join(totals.select("shard", "counts"), "shard").select("pairs", "counts")
    return both.mapInPandas(run, "a long, most long").groupBy("a").agg(F.max("most").alias("most"))


def looked_up(rows: DataFrame, sizes, index, counts, most) -> DataFrame:
    """``rows`` with the links of these shards added to n_best and count_sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, known = index.value, counts.value
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                row, pair = linked(part, *sizes.value)
                at = of(pair)
                row, pair, count = row[at >= 0], pair[at >= 0], known[at[at >= 0]]
                best = count == most.value[pair >> ID_BITS]
                added = {
                    "n_best": np.bincount(row[best], minlength=part.num_rows),
                    "count_sum": _sums(row, count, part.num_rows),
                }
                columns = [
                    pa.array(part.column(c).to_numpy() + added[c]) if c in added else part.column(c)
                    for c in part.schema.names
                ]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return rows.mapInArrow(run, rows.schema)


def _sums(row: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Sums by row, whose numbers ascend, as whole numbers of 64 bits."""
    upto = np.concatenate([[0], np.cumsum(count)])
    return upto[np.searchsorted(row, np.arange(n), "right")] - upto[np.searchsorted(row, np.arange(n), "left")]


def align(
    docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, shard_pairs: int = SHARD_PAIRS, pass_pairs: int = PASS_PAIRS
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of ``docs`` (doc_id, text), a row per row."""
    sc = docs.sparkSession.sparkContext
    rows = keep(encoded(docs, a_file, b_file))
    with open(a_file, "rb") as a, open(b_file, "rb") as b:
        encoders = Encoders(a.read(), b.read())
    sizes = sc.broadcast(encoders.sizes)
    pairs = keep(distinct_pairs(rows, sizes))
    n_shards = max(1, -(-pairs.count() // shard_pairs))
    functions = keep(functions_of(pairs, n_shards))
    per_pass = max(1, pass_pairs // shard_pairs)
    passes, highest = [], np.zeros(len(encoders.a_bytes), np.int64)
    for first in range(0, n_shards, per_pass):
        here = functions.where(F.col("shard").between(first, first + per_pass - 1))
        index = sc.broadcast(_index(here, n_shards))
        totals = keep(tree_sum(counted(rows, sizes, index)))
        for a, most in highest_counts(here, totals).toPandas().itertuples(index=False):
            highest[a] = max(highest[a], most)
        passes.append((here, totals))
        index.unpersist()
    most = sc.broadcast(highest)
    for here, totals in passes:
        of = _index(here, n_shards)
        vectors = {r.shard: np.frombuffer(r.counts, "<i8") for r in totals.toLocalIterator()}
        known = np.concatenate([np.zeros(0, np.int64), *(vectors[s] for s in of.first)])
        rows = looked_up(rows, sizes, sc.broadcast(of), sc.broadcast(known), most)
        if totals is not passes[-1][1]:
            rows = keep(rows)  # or every pass would hold its broadcasts at once
    return rows.drop("a", "b")


def _index(functions: DataFrame, n_shards: int) -> PairIndex:
    return PairIndex(
        [(r.shard, list(r.sizes), np.frombuffer(r.words, "<u8"), np.frombuffer(r.pairs, "<i8"))
         for r in functions.orderBy("shard").toLocalIterator()], n_shards,
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the table."""
    return align(table(spark, sf_dir, "documents"))
