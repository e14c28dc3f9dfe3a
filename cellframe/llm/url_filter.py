"""URL filters: ordered rules, and a blocked Bloom filter of listed URLs in front of an exact join.

A listed URL is compared in canonical form. The filter is a table of blocks of eight 32-bit words; an address picks
one block and one bit in each of its words, so a probe is one equi-join on the block number. What passes is joined
exactly with the list, which removes every false positive; a listed URL always passes. Everything is built-in SQL.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and is never listed. Repeated
rows are judged alike. Empty tables give an empty result, an empty list lists nothing. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellframe.llm.shared import keep, small, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)[?]?([^#]*)"
WORDS_PER_BLOCK = 8
BITS_PER_URL = 16
#: A block is a row of 72 bytes, so that at most 20 MB are broadcast.
BROADCAST_BLOCKS = 200_000


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
#: The exact list is broadcast up to so many bytes of URLs and so many of them.
BROADCAST_BYTES, BROADCAST_URLS = 32 << 20, 500_000
# Kinds of sites as block lists sort them. The registered query lists the pages of every site that has such
# a word in its name, set off by dots or hyphens.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")
LISTED_HOST = f"(^|[.-])({'|'.join(LISTED_WORDS)})[.-]"


def host_of(url: str) -> str:
    return f"translate(regexp_extract(coalesce({url}, ''), '{PARTS}', 1), '{UPPER}', '{LOWER}')"


def path_of(url: str) -> str:
    return f"regexp_extract(coalesce({url}, ''), '{PARTS}', 2)"


def canonical_of(url: str, engine: str = "spark") -> str:
    """SQL: host without ``www.``, ``m.`` and port, path without ending, query without tracking, no fragment."""
    every = ", 'g'" if engine == "duckdb" else ""
    host = f"regexp_replace({host_of(url)}, '^(www|m)[.]|:[0-9]*$', ''{every})"
    path = f"regexp_replace({path_of(url)}, '(/index)?([.]html?)?/*$', '')"
    query = f"regexp_extract(coalesce({url}, ''), '{PARTS}', 3)"
    query = f"regexp_replace({query}, '(^|&)(utm_[^&=]*|ref)(=[^&]*)?', ''{every})"
    query = f"regexp_replace({query}, '^&', '')"
    return f"concat({host}, {path}, CASE WHEN {query} = '' THEN '' ELSE concat('?', {query}) END)"


def ruling(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits the columns ``host`` and ``path``; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        host = F.col("host")
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _bits(canonical: str) -> list[Column]:
    """One bit number for each word of the block."""
    digest = F.xxhash64(F.lit("bits"), F.col(canonical))
    return [F.shiftrightunsigned(digest, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS_PER_BLOCK)]


def _block(canonical: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), F.col(canonical)), F.lit(blocks))


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 … w7) of the column ``canonical``; partial results merge by OR, so a task sends a row per block."""
    masks = [F.expr(f"shiftleft(1L, b{i})") for i in range(WORDS_PER_BLOCK)]
    return (
        listed.select(_block("canonical", blocks).alias("block"),
                      *[b.alias(f"b{i}") for i, b in enumerate(_bits("canonical"))])
        .groupBy("block")
        .agg(*[F.bit_or(m).alias(f"w{i}") for i, m in enumerate(masks)])
    )


def in_list(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """``rows`` (with ``canonical``) and a boolean ``listed``; ``listed`` has one row per canonical URL."""
    n, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("canonical")), F.lit(0))).first()
    blocks = 2 ** max(0, math.ceil(math.log2(max(1, n * BITS_PER_URL / (32 * WORDS_PER_BLOCK)))))
    bloom = small(bloom_filter(listed, blocks), BROADCAST_BLOCKS)
    hit = F.lit(True)
    for i, bit in enumerate(_bits("canonical")):
        hit = hit & (F.expr(f"w{i}").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)) != 0)
    words = [f"w{i}" for i in range(WORDS_PER_BLOCK)]
    # What the filter stops has no URL to join by, so it meets nothing; its hash alone spreads it over the tasks.
    probed = (
        rows.withColumn("block", _block("canonical", blocks))
        .join(bloom, "block", "left")
        .withColumn("possible", F.coalesce(hit, F.lit(False)))
        .withColumn("wanted", F.when(F.col("possible"), F.col("canonical")))
        .withColumn("spread", F.when(F.col("possible"), F.lit(0).cast("bigint")).otherwise(F.xxhash64("canonical")))
        .drop("block", "possible", *words)
    )
    exact = listed.select(
        F.col("canonical").alias("wanted"), F.lit(0).cast("bigint").alias("spread"), F.lit(True).alias("listed")
    )
    if n <= BROADCAST_URLS and size <= BROADCAST_BYTES:
        exact = F.broadcast(exact)
    return probed.join(exact, ["wanted", "spread"], "left").drop("wanted", "spread").withColumn(
        "listed", F.coalesce("listed", F.lit(False))
    )


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """A verdict for every row of ``pages`` (page_id, url): the longest rule's, else block what is ``listed`` (url)."""
    canonical = keep(
        listed.select(F.expr(canonical_of("url")).alias("canonical"), F.expr(host_of("url")).alias("host"))
        .where("host <> ''").select("canonical").distinct()
    )
    rows = pages.select(
        "page_id", F.expr(host_of("url")).alias("host"), F.expr(path_of("url")).alias("path"),
        F.expr(canonical_of("url")).alias("canonical"),
    )
    rule, verdict = ruling(rules)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return in_list(rows, canonical).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "listed"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, against the canonical URLs of all pages on sites of the listed kinds."""
    pages = table(spark, sf_dir, "pages")
    return judge(pages, pages.where(F.expr(host_of("url")).rlike(LISTED_HOST)).select("url"))


_fits = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
_cases = [
    (_fits.format(h=r.host, p=r.path), r) for r in sorted(RULES, key=lambda r: (len(r.name), r.name), reverse=True)
]
SQL = f"""
WITH u AS (
  SELECT page_id, {host_of('url')} AS host, {path_of('url')} AS path, {canonical_of('url', 'duckdb')} AS canonical
  FROM pages
), listed AS (
  SELECT DISTINCT canonical FROM u WHERE regexp_matches(host, '{LISTED_HOST}')
), ruled AS (
  SELECT u.*, CASE {" ".join(f"WHEN {c} THEN '{r.name}'" for c, r in _cases)} END AS rule,
    CASE {" ".join(f"WHEN {c} THEN '{r.verdict}'" for c, r in _cases)} END AS by_rule,
    host <> '' AND canonical IN (SELECT canonical FROM listed) AS listed
  FROM u
)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM ruled
"""
