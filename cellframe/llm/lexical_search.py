"""Ranked search of all documents for each item, by exact matrix products of dense blocks.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z lower-cased. A term weighs
``floor(1000 ln((2N + 2) / (2 df + 1)))``, N being the documents with a term and df those that hold this one; in a
document of n terms, of L in all, tf occurrences have the impact ``10^9 tf div (1000 tf + 20 m)`` with
``m = 50 + 50 n N div L``. A document's score is the sum of weight times impact over the item's different terms.

Items go in tiles, each with a vocabulary of its own terms only; a tile's weights are a dense matrix, vocabulary by
items. Documents are first reduced to the counts of terms that any item has, and a tile of them becomes a dense matrix of
impacts, documents by vocabulary. BLAS multiplies both in float64. An impact is below 10^6, and the vocabulary is cut into
slices in which weights times 10^6 add up to less than 2^53, so every partial sum is an exact integer, in whatever order
BLAS adds; slices are added as 64-bit integers.

Each task keeps the best of every item by (score, doc_id); a document that equals the worst of them in score stays in the
running until its id decides. The best of all tasks are ranked once more.

All documents are read for all items, in blocks. If the items have more than ``PART_TERMS`` terms together, they are dealt
into parts by a hash of their id and the documents are counted once for each part, so what is broadcast, or comes to the
driver, never grows beyond a part: its terms, their document counts, its items.

Defined cases: a null text, or one without terms, holds nothing and does not count in N; an item without terms, or whose
terms score nowhere, has no rows. Rows that share an item_id are one item with the terms of all (null being an id like
any other). Every row of documents is a document; one without an id is counted, and comes last among equal scores. Long
texts are counted in pieces. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cellframe.llm.shared import keep, table

TOP = 50
PART_TERMS = 500_000
TILE_ITEMS = 256
TILE_DOCS = 512
COLUMNS = 4_096
IMPACT = 1_000_000_000
#: Impacts stay below this, whatever the counts.
MOST_IMPACT = IMPACT // 1_000
ROWS_AT_ONCE = 256
PIECE = 1 << 20
#: Candidates that a task holds before it cuts them down to the best of each item.
HELD = 50_000
#: Bytes to terms: A-Z become a-z, all other ASCII but digits and letters becomes a blank.
TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def term_counts(text: bytes | None) -> Iterator[Counter]:
    """The terms of a text with their numbers, of one piece after another."""
    text = (text or b"").translate(TERM_BYTES)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield Counter(text[at:end].split())
        at = end


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the different terms of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, terms = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = {t for counts in term_counts(text) for t in counts}
                at += [i] * len(found)
                terms += found
            ids = batch.column("item_id").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(terms, pa.binary())], names=["item_id", "term"])

    rows = items.select("item_id", F.col("text").cast("binary").alias("text"))
    schema = rows.select("item_id", F.col("text").alias("term")).schema
    return rows.mapInArrow(run, schema).distinct()


def document_counts(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, at, tf) of documents that have terms: n terms, and the counts of those at ``at`` of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: i for i, term in enumerate(vocabulary.value)}
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                rows, sizes, at, tf, ends = [], [], [], [], [0]
                for i, text in enumerate(part.column("text").to_pylist()):
                    n, known = 0, Counter()
                    for counts in term_counts(text):
                        n += counts.total()
                        for term in counts.keys() & place.keys():
                            known[place[term]] += counts[term]
                    if n:
                        rows.append(i)
                        sizes.append(n)
                        at += known
                        tf += known.values()
                        ends.append(len(at))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(at, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64())),
                    ],
                    names=["doc_id", "n", "at", "tf"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, at array<int>, tf array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Tile:
    """Some items, the weights of their own vocabulary in dense slices, and the best documents so far."""

    def __init__(self, items: np.ndarray, terms: list[np.ndarray], weights: np.ndarray, top: int):
        self.items, self.top = items, top
        self.columns = np.unique(np.concatenate(terms))
        of = weights[self.columns]
        self.slices, start = [], 0
        room = (2**53 - 1) // MOST_IMPACT
        upto = np.cumsum(of)
        while start < len(self.columns):
            before = upto[start - 1] if start else 0
            stop = min(start + COLUMNS, int(np.searchsorted(upto, before + room, "right")))
            if stop == start:
                raise OverflowError("a weight leaves no room for an exact sum")
            dense = np.zeros((stop - start, len(items)))
            for i, t in enumerate(terms):
                at = np.searchsorted(self.columns, t)
                at = at[(at >= start) & (at < stop)]
                dense[at - start, i] = of[at]
            self.slices.append((start, stop, dense))
            start = stop
        self.least = np.ones(len(items), np.int64)
        self.found = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]

    def add(self, doc: np.ndarray, at: np.ndarray, impact: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        """A tile of documents: the impacts of terms ``at`` in the documents ``doc``."""
        column = np.searchsorted(self.columns, at)
        known = column < len(self.columns)
        known[known] = self.columns[column[known]] == at[known]
        doc, column, impact = doc[known], column[known], impact[known]
        scores = np.zeros((len(ids), len(self.items)), np.int64)
        for start, stop, dense in self.slices:
            here = (column >= start) & (column < stop)
            impacts = np.zeros((len(ids), stop - start))
            impacts[doc[here], column[here] - start] = impact[here]
            scores += (impacts @ dense).astype(np.int64)
        # equals of the worst stay: their ids decide when they are cut
        row, item = np.nonzero(scores >= self.least)
        new = item, scores[row, item], ids[row], unnamed[row]
        self.found = [np.concatenate(pair) for pair in zip(self.found, new)]
        if len(self.found[0]) > HELD + self.top * len(self.items):
            self.cut()

    def cut(self) -> None:
        item, score, ids, unnamed = self.found
        order = np.lexsort((ids, unnamed, -score, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order], "left")
        worst = order[rank == self.top - 1]
        self.least[item[worst]] = score[worst]
        self.found = [a[order[rank < self.top]] for a in self.found]


def best_of_tasks(rows: DataFrame, part, id_type, top: int) -> DataFrame:
    """(item_id, doc_id, score): of each task the best of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, terms, weights, n_docs, n_terms = part.value
        order = np.argsort([t[0] for t in terms], kind="stable")  # items of like terms share a vocabulary
        tiles = [
            Tile(order[i:i + TILE_ITEMS], [terms[j] for j in order[i:i + TILE_ITEMS]], weights, top)
            for i in range(0, len(order), TILE_ITEMS)
        ]
        for batch in batches:
            for first in range(0, batch.num_rows, TILE_DOCS):
                some = batch.slice(first, TILE_DOCS)
                sizes = some.column("n").to_pylist()
                m = np.array([100 - 50 + 50 * n * n_docs // n_terms for n in sizes], np.int64)
                lists = some.column("at")
                doc = np.repeat(np.arange(len(sizes)), np.diff(lists.offsets.to_numpy()))
                tf = some.column("tf").flatten().to_numpy()
                impact = IMPACT * tf // (1000 * tf + 20 * m[doc])
                ids = some.column("doc_id")
                named, unnamed = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
                for tile in tiles:
                    tile.add(doc, lists.flatten().to_numpy(), impact, named, unnamed)
        for tile in tiles:
            tile.cut()
            item, score, ids, unnamed = tile.found
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(tile.items[item])), pa.array(ids, mask=unnamed), pa.array(score)],
                names=["item_id", "doc_id", "score"],
            )

    schema = rows.select(F.lit(None).cast(id_type).alias("item_id"), "doc_id", F.col("n").alias("score")).schema
    return rows.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, part_terms: int = PART_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    wanted = keep(item_terms(items))
    id_type = wanted.schema["item_id"].dataType
    n_parts = max(1, -(-wanted.count() // part_terms))
    found = []
    for p in range(n_parts):
        of_part = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(n_parts)) == p)
        grouped = of_part.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")).toArrow()
        if not grouped.num_rows:
            continue
        lists = grouped.column("terms").combine_chunks()
        codes = lists.flatten().dictionary_encode()
        at = codes.indices.to_numpy()
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        vocabulary = codes.dictionary.to_pylist()
        rows = keep(document_counts(docs, spark.sparkContext.broadcast(vocabulary)))
        n_docs, n_terms = rows.agg(F.count("*"), F.sum("n")).first()
        weights = np.array([weight(n_docs, 0)] * len(vocabulary), np.int64)
        held = rows.select(F.explode("at").alias("at")).groupBy("at").agg(F.count("*").alias("df")).toArrow()
        for i, df in zip(held.column("at").to_pylist(), held.column("df").to_pylist()):
            weights[i] = weight(n_docs, df)
        names = grouped.column("item_id").combine_chunks()
        terms = [np.sort(at[a:b]) for a, b in zip(ends, ends[1:])]
        part = spark.sparkContext.broadcast((names, terms, weights, n_docs, n_terms or 1))
        found.append(best_of_tasks(rows, part, id_type, top))
    if not found:
        found = [wanted.select("item_id", F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))]
    best = found[0]
    for part in found[1:]:
        best = best.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS.format("text")} AS terms FROM documents),
stats AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM doc WHERE len(terms) > 0),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark),
held AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM doc)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, stats GROUP BY term
),
scores AS (
  SELECT item_id, row, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM wanted JOIN held USING (term) JOIN weights USING (term), stats GROUP BY ALL
),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
