"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibration.

Every word has a sparse random index vector, taken from a table by its checksum. A word of the vocabulary gets the sum
of its neighbours' index vectors in the labelled sample, shifted by their distance (random indexing); other words keep
their index vector. A
document's features are the mean of its words' vectors, where a word that repeats the one before counts once more as such, the length of that mean and the logarithm
of the number of words. A network with one hidden layer is trained on them in numpy, and the temperature that makes its
probabilities likeliest is found on rows it has not seen.

Bounds of the fit, all documented parameters: about ``TRAIN_ROWS`` labelled rows give features, about ``WORD_ROWS`` of
them the words' neighbours, for at most ``VOCABULARY`` words; whole texts each, chosen by a hash of their id. What
returns to the driver is bounded by them. Scoring covers every row and the whole text.

Defined cases: null and empty texts have zero features and get the score of such; without labelled rows every score is
0.5; labels other than 0 and 1, and null ones, are not learned from; a label without a document is ignored; repeated
rows count as often as they occur; extra columns stay, and ``score`` replaces a column of that name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellframe.llm.shared import crc_remainder, keep, small, table

TRAIN_ROWS = 16_000
WORD_ROWS = 4_000
VOCABULARY = 8_192
MIN_COUNT = 5
DIMENSIONS = 64
NONZERO = 6
INDEX_ROWS = 4_096
REACH = 2
HIDDEN = 32
EPOCHS = 60
THRESHOLD = 0.3
FIT_TASKS = 8
CACHE = 300_000
#: Stands for a word that repeats the one before it, which a mean over words would not show.
AGAIN = "\0again"
_token = re.compile(r"\w+|[^\w\s]+")


def index_table() -> np.ndarray:
    """The sparse ternary vectors; a word takes the row of its checksum."""
    random = np.random.default_rng(7)
    out = np.zeros((INDEX_ROWS, DIMENSIONS), np.float32)
    for row in out:
        row[random.choice(DIMENSIONS, NONZERO, replace=False)] = random.choice([-1.0, 1.0], NONZERO)
    return out


def index_row(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % INDEX_ROWS


def tokens(text: str | None) -> list[str]:
    """Words and runs of other signs; capitals count when a word has nothing else."""
    return [w if len(w) > 1 and w.isupper() else w.lower() for w in _token.findall(text or "")]


class Pool:
    """Texts to features: rows of ``vectors`` belong to the words in ``slots``, then to the index table."""

    def __init__(self, words: list[str], vectors: np.ndarray):
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        index = index_table() / np.float32(NONZERO) ** 0.5
        self.matrix = np.concatenate([vectors / np.maximum(norm, 1e-9), index]).astype(np.float32)
        self.known = {w: i for i, w in enumerate(words)}
        self.slots = dict(self.known)

    def row(self, word: str) -> int:
        at = self.slots.get(word)
        if at is None:
            if len(self.slots) > CACHE + len(self.known):
                self.slots = dict(self.known)
            at = self.slots[word] = len(self.known) + index_row(word)
        return at

    def __call__(self, text: str | None) -> np.ndarray:
        found = tokens(text)
        counts = Counter(found)
        if again := sum(map(eq, found, found[1:])):
            counts[AGAIN] = again
        out = np.zeros(DIMENSIONS + 2, np.float32)
        if counts:
            rows = np.fromiter((self.row(w) for w in counts), np.int64, len(counts))
            times = np.fromiter(counts.values(), np.float32, len(counts))
            mean = times @ self.matrix[rows] / times.sum()
            out[:DIMENSIONS] = mean
            out[DIMENSIONS] = np.linalg.norm(mean)
            out[DIMENSIONS + 1] = np.log1p(times.sum())
        return out


@dataclass
class Network:
    """Two layers over standardised features, and the temperature of its logits."""

    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.center) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Network:
    """Adam on the rows that are not ``held``; the temperature is fitted on those that are."""
    random = np.random.default_rng(3)
    fit = x[~held] if (~held).any() else x
    goal = y[~held] if (~held).any() else y
    n, d = fit.shape
    center, scale = fit.mean(axis=0), fit.std(axis=0) + 1e-3
    z = (fit - center) / scale
    rate = (goal.sum() + 1) / (n + 2)
    parts = [random.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), random.normal(0, 0.1, HIDDEN),
             np.array(np.log(rate / (1 - rate)))]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(n)
        for start in range(0, n, 256):
            some = order[start:start + 256]
            h = np.tanh(z[some] @ parts[0] + parts[1])
            p = 1 / (1 + np.exp(-np.clip(h @ parts[2] + parts[3], -40, 40)))
            error = (p - goal[some]) / len(some)
            back = np.outer(error, parts[2]) * (1 - h * h)
            grads = [z[some].T @ back + 1e-4 * parts[0], back.sum(axis=0), h.T @ error + 1e-4 * parts[2], error.sum()]
            step += 1
            pace = 3e-3 * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                parts[i] = parts[i] - pace * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(center, scale, parts[0], parts[1], parts[2], float(parts[3]))
    if held.any():
        logits = net.logits(x[held])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 80))
        loss = [np.logaddexp(0, np.where(y[held] == 1, -1, 1) * logits / t).mean() for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, quality, place): about TRAIN_ROWS labelled rows; ``place`` orders them at random."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "quality")
    n = known.count()
    place = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    share = min(1.0, TRAIN_ROWS / n) if n else 0.0
    chosen = known.withColumn("place", place / (share or 1.0)).where("place < 1.0")
    return docs.select("doc_id", "text").join(small(chosen), "doc_id")


def word_vectors(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """The vocabulary and the sums of its words' neighbours over the sample (doc_id, text)."""
    sample = sample.repartition(FIT_TASKS, "doc_id")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter()
            for text in batch["text"]:
                found.update(tokens(text))
            yield pd.DataFrame({"word": list(found), "n": list(found.values())})

    counted = sample.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = sorted(r.word for r in counted.where(F.col("n") >= MIN_COUNT).orderBy(F.desc("n"), "word")
                   .limit(VOCABULARY).collect())
    names = [f"d{i}" for i in range(DIMENSIONS)]

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots, index = {w: i for i, w in enumerate(words)}, index_table()
        total = np.zeros((len(words), DIMENSIONS), np.float64)
        for batch in batches:
            for text in batch["text"]:
                found = tokens(text)
                if not found:
                    continue
                vectors = index[[index_row(w) for w in found]]
                near = np.zeros_like(vectors)
                for shift in range(1, REACH + 1):
                    near[shift:] += np.roll(vectors[:-shift], shift, axis=1)
                    near[:-shift] += np.roll(vectors[shift:], -shift, axis=1)
                at = np.array([slots.get(w, -1) for w in found])
                np.add.at(total, at[at >= 0], near[at >= 0])
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        out = pd.DataFrame(total[used], columns=names)
        out.insert(0, "slot", used)
        yield out

    sums = (
        sample.mapInPandas(gather, "slot long, " + ", ".join(f"{n} double" for n in names))
        .groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    )
    vectors = np.zeros((len(words), DIMENSIONS))
    vectors[sums["slot"].to_numpy(dtype=int)] = sums[names].to_numpy()
    return words, vectors


@dataclass
class Model:
    words: list[str]
    vectors: np.ndarray
    network: Network | None


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns ``quality`` of ``labels`` (doc_id, quality) from ``docs`` (doc_id, text)."""
    sample = keep(_sample(docs, labels))
    rows = sample.count()
    words, vectors = word_vectors(sample.where(F.col("place") < min(1.0, WORD_ROWS / max(1, rows))))
    shared = docs.sparkSession.sparkContext.broadcast((words, vectors))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = Pool(*shared.value)
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "quality": batch["quality"], "place": batch["place"],
                "x": [pool(t) for t in batch["text"]],
            })

    made = sample.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int"), "place", "text")
    found = made.mapInPandas(features, "doc_id long, quality int, place double, x array<float>").toPandas()
    if not len(found):
        return Model(words, vectors, None)
    found["key"] = [tuple(v) for v in found["x"]]
    found = found.sort_values(["place", "doc_id", "key"])
    x = np.stack(found["x"].to_numpy()).astype(np.float64)
    held = np.arange(len(found)) % 5 == 0 if len(found) >= 50 else np.zeros(len(found), bool)
    return Model(words, vectors, train(x, found["quality"].to_numpy(dtype=float), held))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the probability that its ``text`` has quality 1."""
    # plain arrays: workers need not be able to import the class to unpickle them
    weights = vars(model.network) if model.network is not None else None
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.vectors, weights))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words, vectors, weights = shared.value
        network = Network(**weights) if weights is not None else None
        pool = Pool(words, vectors)
        for texts in batches:
            if network is None or not len(texts):
                yield pd.Series(np.full(len(texts), 0.5))
            else:
                yield pd.Series(network.score(np.stack([pool(t) for t in texts]).astype(np.float64)))

    return docs.withColumn("score", F.pandas_udf(run, "double")("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document; a fifth of the labels, by the checksum of their id, is not learned from."""
    docs, held_out = table(spark, sf_dir, "documents"), crc_remainder("doc_id", 5) == 0
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = score(docs.select("doc_id", "text"), model)
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.cast("int").alias("predicted"))
