"""Scalar conversions: 1960-epoch numbers and typed Spark values to cell slots.

Each function takes and returns the text of a SQL expression, for ``F.expr`` and
``selectExpr``: a whole conversion is then one call into the JVM. No conversion raises
for a data value (ANSI mode is on in Spark 4, hence the range guard in front of each
narrowing cast). NaN orders above every number, so a range guard also turns NaN, a
missing number, into null.
"""

from __future__ import annotations

# The dataset epoch is 1960-01-01, 3653 days before 1970-01-01.
EPOCH_DAYS = 3653
SECONDS_PER_DAY = 86400
EPOCH_SECONDS = EPOCH_DAYS * SECONDS_PER_DAY
# Days from 1960-01-01 to 0001-01-01 and to 9999-12-31.
MIN_DAY, MAX_DAY = -715509, 2936549
INT_MAX = 2**31 - 1


def text(v: str) -> str:
    return f"CAST({v} AS STRING)"


def double(v: str) -> str:
    """A number; NaN is a missing number, as null is."""
    return f"nanvl(CAST({v} AS DOUBLE), CAST(NULL AS DOUBLE))"


def text_as_double(v: str) -> str:
    """A number written as text; null where it is not one."""
    return f"nanvl(try_cast({v} AS DOUBLE), CAST(NULL AS DOUBLE))"


def _within(v: str, low: str, high: str) -> str:
    d = f"CAST({v} AS DOUBLE)"
    return f"CASE WHEN {d} {low}D AND {d} {high}D THEN {d} END"


def days_to_date(v: str) -> str:
    """Days since 1960-01-01, the fraction dropped; null outside years 1-9999."""
    days = _within(v, f"> {MIN_DAY - 1}", f"< {MAX_DAY + 1}")
    return f"date_add(DATE'1960-01-01', CAST({days} AS INT))"


def seconds_to_time(v: str) -> str:
    """Whole seconds, the fraction dropped; not wrapped at 24 hours."""
    return f"CAST({_within(v, f'> {-INT_MAX - 1}', f'< {INT_MAX + 1}')} AS INT)"


def time_text(seconds: str) -> str:
    """``HH:mm:ss`` of whole seconds; a leading ``-`` below zero, hours unbounded."""
    # bigint first: abs(-2147483648) does not fit an int
    whole = f"abs(CAST({seconds} AS BIGINT))"
    hours = f"CAST({whole} div 3600 AS STRING)"
    return (
        f"concat(CASE WHEN {seconds} < 0 THEN '-' ELSE '' END, "
        f"CASE WHEN {whole} < 360000 THEN lpad({hours}, 2, '0') ELSE {hours} END, ':', "
        f"lpad(CAST({whole} div 60 % 60 AS STRING), 2, '0'), ':', "
        f"lpad(CAST({whole} % 60 AS STRING), 2, '0'))"
    )


def _in_calendar(v: str) -> str:
    return _within(v, f">= {MIN_DAY * SECONDS_PER_DAY}", f"< {(MAX_DAY + 1) * SECONDS_PER_DAY}")


def seconds_to_timestamp(v: str) -> str:
    """Seconds since 1960-01-01 00:00 UTC, to the nearest microsecond."""
    whole = f"floor({_in_calendar(v)})"
    # Whole and fractional seconds apart: v * 1e6 as one double loses the last digits.
    micros = f"CAST(round((CAST({v} AS DOUBLE) - {whole}) * 1000000) AS BIGINT)"
    return f"timestamp_micros(({whole} - {EPOCH_SECONDS}) * 1000000 + {micros})"


def seconds_to_time_of_day(v: str) -> str:
    """Seconds since 1960-01-01 to second of the day, UTC; the date part is dropped."""
    return f"CAST(pmod(floor({_in_calendar(v)}), {SECONDS_PER_DAY}) AS INT)"


# Microseconds since 1970 (`m`) of instants, local times and dates: local times and dates are meant as UTC, and no
# expression here depends on the session's time zone.

MICROS_PER_DAY = SECONDS_PER_DAY * 1_000_000


def micros_of_instant(v: str) -> str:
    return f"unix_micros({v})"


def micros_of_date(v: str) -> str:
    return f"(CAST(unix_date({v}) AS BIGINT) * {MICROS_PER_DAY}L)"


def micros_of_local(v: str) -> str:
    """Of a timestamp without time zone, from its fields: a cast to an instant would go by the session's zone."""
    seconds = f"(hour({v}) * 3600L + minute({v}) * 60L)"
    return (
        f"({micros_of_date(f'CAST({v} AS DATE)')} + {seconds} * 1000000L "
        f"+ CAST(extract(SECOND FROM {v}) * 1000000 AS BIGINT))"
    )


def micros_to_date(m: str) -> str:
    return f"date_from_unix_date(CAST(({m} - pmod({m}, {MICROS_PER_DAY}L)) div {MICROS_PER_DAY}L AS INT))"


def micros_to_timestamp(m: str) -> str:
    return f"timestamp_micros({m})"


def micros_to_time_of_day(m: str) -> str:
    """Second of the day, UTC."""
    return f"CAST(pmod({m}, {MICROS_PER_DAY}L) div 1000000L AS INT)"
