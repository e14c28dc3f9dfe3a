"""The corpus pipeline: five stages over documents, each written as a table before the next one reads it.

Every stage takes all rows its predecessor kept. Language ID removes what it rejects (texts without a letter, and those
whose best language is less likely than all others together); line dedup removes repeated lines, and documents that
consist of nothing else; near dedup keeps the first document of each group; decontamination removes documents that
contain a benchmark item; mixing repeats documents to the target weights of their sources.

A document without an id passes the stages that decide by id. Rows that repeat an id and a text are kept together.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellframe.llm import decontamination, language_id, line_dedup, mixing, near_dedup
from cellframe.llm.shared import crc_remainder, keep, kept_dir, small, table

MIN_LANGUAGE_SCORE = 0.5
SHINGLE, PERCENT = 5, 80
#: Not as many as the operator allows by itself: documents of one line that are merely alike are near dedup's to judge.
LINE_EDITS = 1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told with a score of at least ``MIN_LANGUAGE_SCORE``."""
    model = language_id.fit(docs.where(crc_remainder("doc_id", 3) != 1))
    told = language_id.predict(docs, model)
    wanted = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return told.where(wanted).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that are alike to an earlier one, and documents of which only blank lines are left by that."""
    done = line_dedup.dedup(docs, LINE_EDITS)
    return done.where("n_removed = 0 OR trim(BOTH ' \t\n\r' FROM text) <> ''").select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    groups = near_dedup.near_duplicates(docs, SHINGLE, PERCENT)
    dropped = keep(groups.where("NOT kept").select("doc_id").distinct())
    return docs.join(small(dropped), "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents in which a benchmark item occurs."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents until sources weigh what they should, shuffled globally."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]
#: Trained, sketched and aligned decisions are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Every stage's result lies as Parquet in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{kept_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
