"""Reading numbers and text out of binary values with built-in functions.

Each function takes and returns the text of a SQL expression.
"""

from __future__ import annotations

import codecs

from cellframe.functions.formats import quoted

# Number layout of transport files. One sign bit, a 7-bit base-16
# exponent biased by 64, then 56 fraction bits.
_FRACTION_BITS = 56
_FRACTION_MASK = (1 << _FRACTION_BITS) - 1
_EXPONENT_BIAS = 64 + _FRACTION_BITS // 4
# First byte of a missing number, all other bytes being zero.
MISSING_MARKS = "._ABCDEFGHIJKLMNOPQRSTUVWXYZ"

UNICODE, LATIN1 = "UTF-8", "ISO-8859-1"


def check_encoding(encoding: str) -> str:
    """The encoding's own name: UTF-8, ISO-8859-1, or any code page with one byte a character that extends ASCII."""
    known = {"utf-8": UNICODE, "iso8859-1": LATIN1}
    try:
        name = codecs.lookup(encoding).name
        if name not in known and not _extends_ascii(name):
            raise LookupError(name)
    except (LookupError, UnicodeError):
        raise ValueError(f"encoding {encoding!r} is neither {UNICODE} nor a code page of single bytes that extends ASCII") from None
    return known.get(name, name)


def _extends_ascii(name: str) -> bool:
    first, half = bytes(range(128)), _upper_half(name)
    alone = all(len(bytes([b, 65]).decode(name, "replace")) == 2 for b in range(128, 256))  # no byte leads another
    return first.decode(name) == first.decode("ascii") and any(half) and alone


def _upper_half(name: str) -> list[str]:
    """The characters of bytes 128 to 255, empty where a byte stands for none."""
    return [bytes([b]).decode(name, "ignore") for b in range(128, 256)]


def code_page(name: str) -> tuple[str, str, str]:
    """Characters of ISO-8859-1 and what their bytes mean in a code page instead, and those whose bytes mean nothing."""
    table = [(chr(128 + i), c) for i, c in enumerate(_upper_half(name))]
    moved = [(byte, c) for byte, c in table if c and c != byte]
    return "".join(b for b, _ in moved), "".join(c for _, c in moved), "".join(b for b, c in table if not c)


def slice_bytes(content: str, start: str | int, size: str | int) -> str:
    """``size`` bytes from the 0-based ``start``."""
    first = str(start + 1) if isinstance(start, int) else f"CAST({start} + 1 AS INT)"
    count = str(size) if isinstance(size, int) else f"CAST({size} AS INT)"
    return f"substr({content}, {first}, {count})"


def bound(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for a value that is fetched only once.

    Inside a lambda, every mention of a binary column copies all of its bytes out of
    the row; a lambda variable is a plain reference.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def unsigned(b: str) -> str:
    """Big-endian unsigned integer of up to 7 bytes."""
    return f"CAST(conv(hex({b}), 16, 10) AS BIGINT)"


def hex_float_bits(b: str) -> str:
    """The 64 bits of a base-16 number that may be cut to fewer bytes."""
    # A target base below zero makes conv read 64 bits as signed, so the sign is kept.
    return f"CAST(conv(rpad(hex({b}), 16, '0'), 16, -10) AS BIGINT)"


def hex_float(bits: str) -> str:
    """The number that base-16 bits stand for; null for a missing mark."""
    head = f"CAST(shiftrightunsigned({bits}, {_FRACTION_BITS}) AS INT)"
    fraction = f"({bits} & {_FRACTION_MASK}L)"
    scales = ", ".join(f"{16.0 ** (e - _EXPONENT_BIAS)!r}D" for e in range(128))
    marks = ", ".join(str(ord(c)) for c in MISSING_MARKS)
    size = f"CAST({fraction} AS DOUBLE) * element_at(array({scales}), ({head} & 127) + 1)"
    return (
        f"CASE WHEN {fraction} = 0 THEN CASE WHEN {head} IN ({marks}) THEN NULL "
        f"WHEN {bits} IS NOT NULL THEN 0D END WHEN {bits} < 0 THEN -({size}) ELSE {size} END"
    )


def latin1(b: str) -> str:
    """One character per byte; cannot fail."""
    return f"decode({b}, 'ISO-8859-1')"


def fixed_text(b: str, encoding: str = UNICODE) -> str:
    """Blank-padded text without its padding; null where the bytes are not valid text."""
    name = check_encoding(encoding)
    if name == UNICODE:
        return f"CASE WHEN is_valid_utf8(CAST({b} AS STRING)) THEN rtrim(CAST({b} AS STRING)) END"
    if name == LATIN1:
        return f"rtrim({latin1(b)})"
    found, meant, nothing = map(quoted, code_page(name))
    text = f"translate(rtrim({latin1(b)}), {found}, {meant})"
    return f"CASE WHEN length(translate({latin1(b)}, {nothing}, '')) = length({latin1(b)}) THEN {text} END"


def header_text(b: str, encoding: str = UNICODE) -> str:
    """The same for names and labels: bytes that are not valid are replaced."""
    name = check_encoding(encoding)
    if name == UNICODE:
        return f"rtrim(make_valid_utf8(CAST({b} AS STRING)))"
    if name == LATIN1:
        return f"rtrim({latin1(b)})"
    found, meant, nothing = code_page(name)
    return f"translate(rtrim({latin1(b)}), {quoted(found + nothing)}, {quoted(meant + chr(0xFFFD) * len(nothing))})"


def none_if_blank(s: str) -> str:
    return f"nullif({s}, '')"
