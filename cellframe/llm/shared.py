"""What several operators need: tables that cut lineage, checked broadcasts, words, hosts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space of the word contracts: a word is a run of anything else.
SPACE = r"\x20\x09-\x0D"
#: Rows of 8 to 32 bytes that may be broadcast: 2 million of them stay below 64 MB.
BROADCAST_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_dir(spark: SparkSession) -> str:
    """The folder all executors share; where the cluster names none, one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/kept"


def keep(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{kept_dir(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if a count proves that it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def words(text: str) -> str:
    """SQL: the words of a text column, an empty array for null."""
    return f"filter(split(coalesce({text}, ''), r'[{SPACE}]+'), w -> w <> '')"


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) with 52 random bits, the same in every engine that has MD5."""
    joined = F.concat_ws("|", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def crc_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % divisor
