"""Token counts of sections, by encoding whole documents once and attributing tokens by their offsets.

A document is encoded as a whole, because its sections encoded alone would give other tokens. The tokens' byte lengths
give each token's span; sections are spans of characters, brought to bytes; both are ordered, so an interval join by
binary search tells each token's section. A token that crosses a boundary goes by an explicit rule:

* ``start``: to the section that holds its first byte;
* ``most``: to the section that holds most of its bytes, the first of equals;
* ``split``: to each section by the share of its bytes there.

Bytes outside all sections give tokens to none. Sections of a document must not overlap; they may be empty or in any
order, and what reaches beyond the text is cut off.

The tokenizer is a public byte-level BPE vocabulary read from a file, whose path is a parameter; each task loads it.
Special tokens' strings in a text are ordinary text.

Defined cases: a null text counts as an empty one; a null list of sections as none; as lines, an empty
text is one empty line. Every section gives a row, in the order given; a document without sections gives one row with a
null section and all its tokens outside. Repeated rows give rows each; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellframe.llm.shared import table

VOCABULARY_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How byte-level BPE of this vocabulary cuts a text into words before it merges.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("start", "most", "split")
SCHEMA = "section int, start long, end long, n_tokens double, n_crossing long, doc_tokens long"


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of a text's lines in characters, each with its line end."""
    sizes = np.array([len(line) + 1 for line in text.split("\n")], np.int64)
    ends = np.cumsum(sizes)
    return ends - sizes, np.minimum(ends, len(text))


class Encoder:
    """Whole texts to the byte lengths of their tokens."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in bytes."""
        ids = np.asarray(self.encoding.encode_ordinary(text), np.int64)
        return np.cumsum(self.sizes[ids])


def byte_places(text: str, at: np.ndarray) -> np.ndarray:
    """Places in characters, as places in the UTF-8 bytes."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if len(data) == len(text):
        return at
    starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    return starts[at]


def attribute(ends: np.ndarray, start: np.ndarray, stop: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of the tokens that touch it cross one of its ends. All in bytes."""
    first = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    counts, crossing = np.zeros(len(start)), np.zeros(len(start), np.int64)
    order = np.argsort(start, kind="stable")
    order = order[stop[order] > start[order]]
    if not len(order) or not len(ends):
        return counts, crossing
    a, b = start[order], stop[order]
    # tokens that touch section i are low[i] … high[i]
    low, high = np.searchsorted(ends, a, "right"), np.searchsorted(first, b, "left")
    for edge in (a, b):  # a token crosses an edge that lies inside it
        token = np.minimum(np.searchsorted(ends, edge, "right"), len(ends) - 1)
        crossing[order] += (first[token] < edge) & (edge < ends[token])
    whole_from, whole_to = np.searchsorted(first, a, "left"), np.searchsorted(ends, b, "right")
    same = (whole_from > whole_to) | ((low == high - 1) & ((first[low] < a) & (ends[low] > b)))
    crossing[order] -= same  # one token around a whole section crosses both its ends
    if rule == "start":
        counts[order] = np.searchsorted(first, b, "left") - whole_from
        return counts, crossing
    counts[order] = np.maximum(whole_to - whole_from, 0)
    partial = {int(t) for e in (a, b) for t in np.minimum(np.searchsorted(ends, e, "right"), len(ends) - 1)}
    for t in sorted(partial):
        i = int(np.searchsorted(b, first[t], "right"))
        shares = []
        while i < len(a) and a[i] < ends[t]:
            shares.append((min(b[i], ends[t]) - max(a[i], first[t]), i))
            i += 1
        if len(shares) == 1 and shares[0][0] == ends[t] - first[t]:
            continue  # counted as whole
        if rule == "split":
            for share, i in shares:
                counts[order[i]] += share / (ends[t] - first[t])
        elif shares:
            counts[order[max(shares, key=lambda x: (x[0], -x[1]))[1]]] += 1
    return counts, crossing


def count_tokens(
    docs: DataFrame, sections: Column | None = None, rule: str = "start", vocabulary_file: str = VOCABULARY_FILE
) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing, doc_tokens), a row per section of ``docs`` (doc_id, text).

    ``sections`` is an array of (start, end) in characters, by default the lines. ``n_crossing`` counts the tokens that
    touch the section and another place; ``doc_tokens`` all tokens of the document.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary_file)
        for batch in batches:
            for i in range(0, len(batch), 256):
                yield _rows(batch.iloc[i:i + 256], encoder, rule)

    # ids go as text: pandas would make floating point numbers of a column with nulls
    parts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    if sections is not None:
        parts = docs.select(
            F.col("doc_id").cast("string").alias("doc_id"), "text",
            F.transform(sections, lambda s: s["start"].cast("bigint")).alias("starts"),
            F.transform(sections, lambda s: s["end"].cast("bigint")).alias("ends"),
        )
    counted = parts.mapInPandas(run, "doc_id string, " + SCHEMA)
    return counted.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _rows(batch: pd.DataFrame, encoder: Encoder, rule: str) -> pd.DataFrame:
    ids, columns = [], [[] for _ in range(6)]
    given = "starts" in batch.columns
    for k, (doc, text) in enumerate(zip(batch["doc_id"].array, batch["text"])):
        text = text or ""
        tokens = encoder.ends(text)
        if given:
            starts, ends = batch["starts"].iloc[k], batch["ends"].iloc[k]
            starts, ends = ([], []) if starts is None else (starts, ends)
        else:
            starts, ends = line_spans(text)
        n = len(starts)
        start = np.clip(np.asarray(starts, np.int64), 0, len(text))
        end = np.maximum(np.clip(np.asarray(ends, np.int64), 0, len(text)), start)
        counts, crossing = attribute(tokens, byte_places(text, start), byte_places(text, end), rule)
        ids += [doc] * max(n, 1)
        rows = [range(n), start, end, counts, crossing, [len(tokens)] * n] if n else [[None], [None], [None], [0.0], [0], [len(tokens)]]
        for column, values in zip(columns, rows):
            column.extend(values)
    out = pd.DataFrame(dict(zip(["section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"], columns)))
    out.insert(0, "doc_id", pd.Series(ids, dtype=object))
    return out.astype({"section": "Int32", "start": "Int64", "end": "Int64"})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every line of every document."""
    return count_tokens(table(spark, sf_dir, "documents"))
