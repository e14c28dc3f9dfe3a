"""Display formats: which logical type a format stands for, and how it is written.

Functions named after SQL take and return the text of an expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from cellframe.schema import DATE, TIME, TIMESTAMP

Prefixes = Sequence[tuple[str, str]]

# Format prefixes and the logical type each stands for.
FORMAT_PREFIXES: tuple[tuple[str, str], ...] = (
    ("DATE", DATE),
    ("YYMMDD", DATE),
    ("TIME", TIME),
    ("HHMM", TIME),
    ("DATETIME", TIMESTAMP),
    ("DT", TIMESTAMP),
    ("TOD", TIME),
)
TIME_OF_DAY_PREFIX = "TOD"


def _longest_first(prefixes: Prefixes) -> list[tuple[str, str]]:
    return sorted(prefixes, key=lambda rule: -len(rule[0]))


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def type_from_format(fmt: str, otherwise: str, prefixes: Prefixes = FORMAT_PREFIXES) -> str:
    """Logical type a format stands for; the longest matching prefix wins."""
    rules = " ".join(
        f"WHEN startswith(upper({fmt}), {quoted(prefix)}) THEN {quoted(logical)}"
        for prefix, logical in _longest_first(prefixes)
    )
    return f"CASE {rules} ELSE {otherwise} END" if rules else otherwise


def type_of_format(fmt: str | None, prefixes: Prefixes = FORMAT_PREFIXES) -> str | None:
    """The same rule for a format known while the plan is built."""
    upper = (fmt or "").upper()
    return next((t for p, t in _longest_first(prefixes) if upper.startswith(p)), None)


def is_time_of_day(fmt: str) -> str:
    return f"coalesce(startswith(upper({fmt}), {quoted(TIME_OF_DAY_PREFIX)}), false)"


def format_text(name: str, width: str, decimals: str) -> str:
    """``DATE9.``, ``BEST9.3``, ``9.3`` or ``DATE.``; null when there is no format."""

    def digits(n: str) -> str:
        return f"CASE WHEN {n} > 0 THEN CAST({n} AS STRING) ELSE '' END"

    return (
        f"CASE WHEN length({name}) > 0 OR {width} > 0 "
        f"THEN concat({name}, {digits(width)}, '.', {digits(decimals)}) END"
    )
