"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Every measure is a SQL expression over the words and lines of the whole text; every rule is a measure with bounds. A
document is kept if it passes the two base rules and all rules of the table.

Defined cases: a null text has no words and one empty line, and fails the base rules like an empty one; a ratio with a
zero divisor is 0. Words are runs without white space of ASCII; lines end at ``\\n`` only. A result row per input row,
repeated ids included; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellframe.llm.shared import SPACE, table, words

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
WINDOW = 3

# fixed values: frequent function words
STOP_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "with", "for", "it", "be", "this", "on", "are", "as", "by", "at", "was",
    "der", "die", "das", "und", "ist", "mit", "von", "den", "des", "zu", "für", "nicht", "ein", "eine", "dem", "im",
    "le", "la", "les", "de", "et", "des", "en", "que", "un", "une", "est", "pas", "pour", "qui", "du", "elle", "aux",
    "el", "los", "las", "y", "no", "se", "para", "con", "por", "su", "es", "mi", "al", "lo", "del",
)


@dataclass(frozen=True)
class Threshold:
    """Passes where low <= measure <= high; None leaves a side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def sql(self) -> str:
        tests = [f"({self.measure}) >= {self.low}" if self.low is not None else "",
                 f"({self.measure}) <= {self.high}" if self.high is not None else ""]
        return "(" + (" AND ".join(t for t in tests if t) or "true") + ")"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / {b} END)"


#: Measures: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stop_kinds, n_bangs.
THRESHOLDS = (
    Threshold("word_length", ratio("word_chars", "n_words"), 2, 15),
    Threshold("symbols_per_char", ratio("n_symbols", "word_chars"), None, 0.1),
    Threshold("bangs_per_word", ratio("n_bangs", "n_words"), None, 0.5),
    Threshold("stop_words", "n_stop_kinds", 2),
    Threshold("repeated_lines", ratio("n_dup_lines", "n_lines"), None, 0.3),
)


def repeated_words(w: str) -> list[dict[str, str]]:
    """Steps of named SQL expressions; the last, n_repeat_words, counts words in windows that occur twice or more.

    Windows are compared by their 64-bit hash, sorted with their place, so a text of n words takes n log n steps.
    """
    n = f"size({w})"
    starts = f"CASE WHEN {n} < {WINDOW} THEN array() ELSE sequence(0, {n} - {WINDOW}) END"
    window = ", ".join(f"{w}[i + {j}]" if j else f"{w}[i]" for j in range(WINDOW))
    same = "get(_sorted, j).h = get(_sorted, j - 1).h OR get(_sorted, j).h = get(_sorted, j + 1).h"
    return [
        {"_hashes": f"transform({starts}, i -> xxhash64({window}))"},
        {"_sorted": "CASE WHEN size(array_distinct(_hashes)) = size(_hashes) THEN NULL "
                    "ELSE sort_array(transform(_hashes, (x, i) -> named_struct('h', x, 'i', i))) END"},
        {"_places": "CASE WHEN _sorted IS NULL THEN NULL ELSE sort_array(transform(filter("
                    f"sequence(0, size(_sorted) - 1), j -> coalesce({same}, false)), j -> get(_sorted, j).i)) END"},
        {"n_repeat_words": "CASE WHEN _places IS NULL THEN 0L ELSE aggregate(_places, named_struct('n', 0L, 'at', "
                           f"-{WINDOW}), (s, p) -> named_struct('n', s.n + least({WINDOW}, p - s.at), 'at', p), s -> s.n) END"},
    ]


def measured(docs: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the columns of ``more`` and all measures, one row per row."""
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    out = docs.select("doc_id", *more, F.coalesce("text", F.lit("")).alias("_text")).select(
        "doc_id", *more, "_text", F.expr(words("_text")).alias("_words"),
        F.expr(f"filter(split(_text, '\\n'), l -> l rlike r'[^{SPACE}]')").alias("_lines"),
    )
    steps = repeated_words("_words")
    out = out.withColumns({
        "n_words": F.expr("CAST(size(_words) AS BIGINT)"),
        "word_chars": F.expr("CAST(length(array_join(_words, '')) AS BIGINT)"),
        "n_symbols": F.expr(f"CAST(length(regexp_replace(_text, '[^{SYMBOLS[1:-1]}]+', '')) AS BIGINT)"),
        "n_bangs": F.expr("CAST(length(regexp_replace(_text, '[^!]+', '')) AS BIGINT)"),
        "n_lines": F.expr("CAST(size(_lines) AS BIGINT)"),
        "n_dup_lines": F.expr("CAST(size(_lines) - size(array_distinct(_lines)) AS BIGINT)"),
        "n_stop_kinds": F.expr(f"size(array_intersect(transform(array_distinct(_words), w -> lower(w)), array({stop})))"),
        **{k: F.expr(v) for k, v in steps[0].items()},
    })
    for step in steps[1:]:
        out = out.withColumns({k: F.expr(v) for k, v in step.items()})
    return out


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words")


def judge(docs: DataFrame, thresholds: Sequence[Threshold] = THRESHOLDS) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): the measures, the base rules, and the verdict of all rules."""
    verdict = F.expr(" AND ".join([t.sql() for t in thresholds]) or "true")
    failed = F.expr("array_compact(array(" + ", ".join(f"CASE WHEN NOT {t.sql()} THEN '{t.name}' END" for t in thresholds) + "))")
    return measured(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & verdict).alias("kept"),
        F.array_join(failed, ",").alias("failed_rules"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


_FAILED = ", ".join(f"CASE WHEN NOT {t.sql()} THEN '{t.name}' END" for t in THRESHOLDS)
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
SQL = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[{SPACE}]+'), lambda w: w <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^{SPACE}]')) AS ls
  FROM documents
), triples AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri
  FROM t, range(1, len(ws) - 1) r(i)
), doubled AS (
  SELECT doc_id, i FROM triples QUALIFY count(*) OVER (PARTITION BY doc_id, tri) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM doubled, range(0, {WINDOW}) r(d) GROUP BY doc_id
), measured AS (
  SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^{SYMBOLS[1:-1]}]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(text, '[^!]+', '', 'g')) AS BIGINT) AS n_bangs,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    len(list_filter([{_STOP}], lambda s: list_contains(list_transform(ws, lambda w: lower(w)), s))) AS n_stop_kinds,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN covered c ON c.doc_id = t.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND {" AND ".join(t.sql() for t in THRESHOLDS)} AS kept,
  array_to_string(list_filter([{_FAILED}], lambda x: x IS NOT NULL), ',') AS failed_rules
FROM measured
"""
