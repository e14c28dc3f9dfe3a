import math

import pytest
from pyspark.sql import functions as F

from cellframe.llm import mixing


def test_counts_follow_the_rates(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source")
    )
    got = {r.source: r["count"] for r in mixing.mix(docs, {"a": 3.0, "b": 1.0}).groupBy("source").count().collect()}
    assert abs(got["a"] - 15_000) < 5 * math.sqrt(15_000) and abs(got["b"] - 5_000) < 5 * math.sqrt(5_000)
    salted = mixing.mix(docs, {"a": 3.0, "b": 1.0}, broadcast_rows=0)
    assert salted.exceptAll(mixing.mix(docs, {"a": 3.0, "b": 1.0})).isEmpty()
    assert {r.source: r["count"] for r in salted.groupBy("source").count().collect()} == got


@pytest.mark.parametrize("rate", [0.0, 0.3, 1.0, 29.9, 250.0, 4000.0])
def test_poisson_counts_have_mean_and_variance(spark, rate):
    u = lambda part: mixing.uniform(F.lit("t"), F.col("id").cast("string"), part.cast("string"))
    n = mixing.poisson_count("rate", u)
    row = spark.range(4_000).withColumn("rate", F.lit(rate)).select(n.alias("n")).agg(
        F.avg("n").alias("mean"), F.var_pop("n").alias("var")).first()
    error = 5 * math.sqrt(rate / 4_000)
    assert abs(row["mean"] - rate) <= error and abs(row["var"] - rate) <= 0.15 * rate + error


def test_odd_rows(odd_docs, no_docs):
    out = mixing.mix(odd_docs, {None: 1.0, "s0": 1.0}, total=100_000.0)
    assert out.columns == odd_docs.columns + ["copy", "n_copies", "mix_key"]
    assert {r.source for r in out.select("source").distinct().collect()} <= {None, "s0"}
    assert out.where("copy >= n_copies OR copy < 0").isEmpty()
    assert mixing.mix(no_docs).isEmpty() and mixing.mix(odd_docs, {}).isEmpty()
    again = odd_docs.withColumn("copy", F.lit("mine"))
    assert mixing.mix(again).columns == odd_docs.columns + ["copy", "n_copies", "mix_key"]
    with pytest.raises(ValueError):
        mixing.mix(odd_docs, {"s0": -1.0})
