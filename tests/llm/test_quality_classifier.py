import numpy as np
from pyspark.sql import functions as F

from cellframe.llm import quality_classifier as qc
from cellframe.llm.shared import table

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    out = qc.query(spark, SF_DIR).join(table(spark, SF_DIR, "labels"), "doc_id").where("held_out")
    row = out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("all"),
                  F.avg(F.when(F.col("quality") == 1, F.col("predicted"))).alias("good"),
                  F.avg(F.when(F.col("quality") == 0, 1 - F.col("predicted"))).alias("bad")).first()
    assert row["all"] > 0.97 and row["good"] > 0.98 and row["bad"] > 0.9


def test_temperature_calibrates():
    random = np.random.default_rng(5)
    x = random.normal(size=(4_000, 4))
    y = (random.random(4_000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = qc.train(x, y, np.arange(4_000) % 5 == 0)
    score = net.score(x)
    for low in (0.1, 0.4, 0.7):
        at = (score >= low) & (score < low + 0.2)
        assert abs(score[at].mean() - y[at].mean()) < 0.08


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, "x"), (2, 1, "x"), (8, 0, "x"), (6, None, "x"), (None, 1, "x"), (77, 0, "x"), (9, 3, "x")],
        "doc_id long, quality int, text string")
    model = qc.fit(odd_docs, labels)
    out = qc.score(odd_docs, model)
    assert sorted(out.columns) == sorted(odd_docs.columns) and out.count() == odd_docs.count()
    scores = {r.doc_id: r.score for r in out.collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[4] == scores[5] == scores[6]
    assert qc.score(no_docs, model).isEmpty()
    unlearned = qc.fit(no_docs, labels)
    assert {r.score for r in qc.score(odd_docs, unlearned).collect()} == {0.5}
