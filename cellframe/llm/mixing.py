"""Mixing sources to target weights by Poisson replication.

Source s gets the mean repetition rate ``total * weight(s) / size(s)``, where a size is a sum of characters (or a
number of rows). Each document inverts the Poisson distribution of its source's rate at a number hashed from the seed
and its id, is exploded by that count, and the copies are shuffled globally by a hash of (seed, id, copy). Counts of
different documents are independent, so the mix needs no coordination: a repeated task gives the same copies.

Defined cases: a null source is a source of its own; a null text has size 0; a source without a weight, or whose size
is 0, has rate 0 and gives no copy; weights need not add up to 1, but must be finite and not negative; a null id hashes
as the text 'null'; rows that share an id get the same count. Extra columns stay; the five result columns replace
columns of the same name. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellframe.llm.shared import BROADCAST_ROWS, small, table, uniform

#: With ``weights`` None, a source's weight is its size to this power.
ALPHA = 0.7
SEED = 11
#: Rates are split into independent Poisson parts of at most this mean, so that exp(-mean) stays above 1e-13.
PART = 30.0
#: Terms of one part's distribution function; the rest weighs less than 1e-17.
TERMS = 110


def sizes(docs: DataFrame, unit: str = "chars") -> DataFrame:
    """(source, size): added up in each task before rows are shuffled."""
    amount = F.coalesce(F.length("text"), F.lit(0)).cast("bigint") if unit == "chars" else F.lit(1).cast("bigint")
    return docs.groupBy("source").agg(F.sum(amount).alias("size"))


def rates(
    docs: DataFrame, weights: Mapping[str | None, float] | DataFrame | None = None,
    total: float | None = None, unit: str = "chars", alpha: float = ALPHA,
) -> DataFrame:
    """(source, rate), one row per source. ``total``: the size of the mix, by default that of ``docs``."""
    spark, found = docs.sparkSession, sizes(docs, unit)
    if weights is None:
        weighed = found.withColumn("weight", F.when(F.col("size") > 0, F.pow(F.col("size").cast("double"), F.lit(alpha))))
    else:
        if isinstance(weights, Mapping):
            if any(not math.isfinite(w) or w < 0 for w in weights.values()):
                raise ValueError("weights must be finite and not negative")
            weights = spark.createDataFrame(list(weights.items()), "source string, weight double")
        given = weights.select(F.col("source").alias("given"), F.col("weight").cast("double").alias("weight"))
        weighed = found.join(given, F.col("source").eqNullSafe(F.col("given")), "left").drop("given")
    weighed = weighed.withColumn("weight", F.when(F.col("size") > 0, F.coalesce("weight", F.lit(0.0))).otherwise(0.0))
    sums = weighed.agg(F.sum("weight").alias("w"), F.sum("size").cast("double").alias("s")).first()
    aim, mass = (sums.s if total is None else float(total)) or 0.0, sums.w or 0.0
    rate = F.lit(aim) * (F.col("weight") / F.lit(mass)) / F.col("size") if mass > 0 else F.lit(0.0)
    return weighed.select("source", F.when(F.col("size") > 0, rate).otherwise(0.0).alias("rate"))


def poisson_count(rate: str, u_of) -> Column:
    """The Poisson count of a rate column: how many values of the distribution function lie at or below u.

    ``u_of(part)`` gives the random number of a part. A rate above PART is the sum of equal independent parts, so that
    nothing underflows however large it is.
    """
    parts = F.greatest(F.ceil(F.col(rate) / PART), F.lit(1)).cast("int")
    mean = F.col(rate) / parts
    # state: k, the term p(k), its running sum, and the count so far
    empty = F.struct(F.exp(-mean).alias("p"), F.lit(0.0).alias("below"), F.lit(0).alias("n"))

    def part_count(part: Column) -> Column:
        u = u_of(part)

        def step(s: Column, k: Column) -> Column:
            below = s["below"] + s["p"]
            return F.struct((s["p"] * mean / k).alias("p"), below.alias("below"),
                            (s["n"] + F.when(below <= u, 1).otherwise(0)).alias("n"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), empty, step, lambda s: s["n"])

    return F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda n, part: n + part_count(part))


def mix(
    docs: DataFrame, weights: Mapping[str | None, float] | DataFrame | None = None, total: float | None = None,
    unit: str = "chars", alpha: float = ALPHA, seed: int = SEED, broadcast_rows: int = BROADCAST_ROWS // 10,
) -> DataFrame:
    """``docs`` with each row repeated, plus copy (from 0), n_copies and mix_key, shuffled by mix_key.

    The rates are broadcast only if there are at most ``broadcast_rows`` sources; beyond, documents are joined on source
    and a salt, so that no source is one task. A row is sent to another machine once, when the copies are shuffled.
    """
    docs = docs.drop("copy", "n_copies", "mix_key")
    by_source = rates(docs, weights, total, unit, alpha)
    near = small(by_source, broadcast_rows)
    salts = 1 if near is not by_source else 64
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)) if salts > 1 else F.lit(0).cast("bigint")
    near = near.select(
        F.col("source").alias("_s"), F.col("rate").alias("_rate"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("_t"),
    ).where("_rate > 0")
    near = F.broadcast(near) if salts == 1 else near
    columns = [F.col(c) for c in docs.columns]
    rated = docs.join(near, F.col("source").eqNullSafe(F.col("_s")) & (salt == F.col("_t")))
    who = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    counted = rated.withColumn(
        "n_copies", poisson_count("_rate", lambda part: uniform(F.lit(str(seed)), who, part.cast("string")))
    ).where("n_copies > 0")
    copies = counted.select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)).alias("copy"), "n_copies"
    )
    key = F.md5(F.concat_ws("|", F.lit(f"{seed}"), who, F.lit("copy"), F.col("copy").cast("string")))
    return copies.withColumn("mix_key", key).repartition(F.col("mix_key")).sortWithinPartitions("mix_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed with weights that flatten the sizes of their sources."""
    return mix(table(spark, sf_dir, "documents"))


_U = f"CAST(('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || part), 1, 13)) AS BIGINT) / pow(2, 52)"
_KEY = f"md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|copy|' || copy)"
SQL = f"""
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source
), weighed AS (SELECT source, size, pow(size, {ALPHA}) AS weight FROM sizes WHERE size > 0),
rates AS (
  SELECT source, (SELECT sum(size) FROM sizes) * (weight / (SELECT sum(weight) FROM weighed)) / size AS rate
  FROM weighed
), parts AS (SELECT source, rate, greatest(ceil(rate / {PART}), 1) AS n, rate / greatest(ceil(rate / {PART}), 1) AS mean FROM rates),
cdf AS (
  SELECT source, mean, 1 AS k, exp(-mean) * mean AS p, exp(-mean) AS below FROM parts
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), below + p FROM cdf WHERE k < {TERMS}
), steps AS (SELECT source, list(below) AS belows FROM cdf GROUP BY source),
drawn AS (
  SELECT doc_id, d.source, part, {_U} AS u
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, range(1, CAST(p.n AS BIGINT) + 1) r(part)
), counted AS (
  SELECT doc_id, CAST(sum(len(list_filter(belows, lambda b: b <= u))) AS INTEGER) AS n_copies
  FROM drawn d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source GROUP BY doc_id
), copies AS (
  SELECT d.*, CAST(copy AS INTEGER) AS copy, n_copies
  FROM documents d JOIN counted c USING (doc_id), range(0, n_copies) r(copy)
)
SELECT *, {_KEY} AS mix_key FROM copies
"""
