"""Writes tables as transport file bytes, so that tests and queries have files to read.

The tables at hand contain no dataset files. Everything here is plain column
arithmetic: Spark derives the files from a table, a bounded number of rows per file.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    size: int = 8
    text: bool = False
    label: str = ""
    format: str = ""
    width: int = 0
    decimals: int = 0


def card(name: str, rest: str = "0" * 30) -> bytes:
    return f"HEADER RECORD*******{name:<8}HEADER RECORD!!!!!!!{rest:<32}".encode("ascii")


def pad_card(b: bytes) -> bytes:
    return b + b" " * (-len(b) % 80)


def extended_header(fields: Sequence[Field], member: str = "DATA", label: str = "", library: bool = True) -> bytes:
    """The same in the extended layout (version 8): long names, labels and formats."""
    stamp = b"01JAN24:00:00:00"
    out = b""
    if library:
        out += card("LIBV8") + pad_card(b"SAS     SAS     SASLIB  9.4     X64     " + b" " * 24 + stamp) + pad_card(stamp)
    out += card("MEMBV8", f"{'0' * 17}1600000000140") + card("DSCPTV8")
    out += b"SAS     " + member.ljust(32).encode() + b"SASDATA 9.4     X64     " + stamp
    out += stamp + b" " * 16 + label.encode().ljust(40)[:40] + b" " * 8
    out += card("NAMSTV8", f"000000{len(fields):04d}{'0' * 20}")
    body, at, labels = b"", 0, []
    for n, f in enumerate(fields, 1):
        name, text = f.name.encode(), f.label.encode()
        fits = len(f.format) <= 8
        d = struct.pack(">hhhh", 2 if f.text else 1, 0, f.size, n) + name.ljust(8)[:8] + text.ljust(40)[:40]
        d += f.format.encode().ljust(8)[:8] + struct.pack(">hhhh", f.width, f.decimals, 0, 0)
        d += b" " * 8 + struct.pack(">hhl", 0, 0, at) + name.ljust(32) + struct.pack(">h", len(text))
        body += d.ljust(140, b"\0")
        at += f.size
        if len(name) > 8 or len(text) > 40 or not fits:
            written = f"{f.format}{f.width or ''}.{f.decimals or ''}".encode() if not fits else b""
            labels.append((n, name, text, written))
    out += pad_card(body)
    if labels:
        long_formats = any(r[3] for r in labels)
        records = b""
        for n, *texts in labels:
            sizes = [len(t) for t in texts] + [0] if long_formats else [len(t) for t in texts[:2]]
            records += struct.pack(f">{len(sizes) + 1}H", n, *sizes) + b"".join(texts)
        out += card(f"LABELV{9 if long_formats else 8}", str(len(labels))) + pad_card(records)
    return out + card("OBSV8")


def header(
    fields: Sequence[Field], member: str = "DATA", label: str = "", library: bool = True, descriptor: int = 140,
    text: str = "utf-8",
) -> bytes:
    """All bytes in front of the first record."""
    stamp = b"01JAN24:00:00:00"
    out = b""
    if library:
        out += card("LIBRARY") + pad_card(b"SAS     SAS     SASLIB  9.4     X64     " + b" " * 24 + stamp)
        out += pad_card(stamp)
    out += card("MEMBER", f"{'0' * 17}160000000{descriptor:04d}") + card("DSCRPTR")
    out += b"SAS     " + member.ljust(8).encode() + b"SASDATA 9.4     X64     " + b" " * 24 + stamp
    out += stamp + b" " * 16 + label.encode(text).ljust(40)[:40] + b" " * 8
    out += card("NAMESTR", f"000000{len(fields):04d}{'0' * 20}")
    body, at = b"", 0
    for n, f in enumerate(fields, 1):
        d = struct.pack(">hhhh", 2 if f.text else 1, 0, f.size, n)
        d += f.name.encode(text).ljust(8)[:8] + f.label.encode(text).ljust(40)[:40]
        d += f.format.encode().ljust(8)[:8] + struct.pack(">hhhh", f.width, f.decimals, 0, 0)
        d += b" " * 8 + struct.pack(">hhl", 0, 0, at)
        body += d.ljust(descriptor, b"\0")
        at += f.size
    return out + pad_card(body) + card("OBS")


def hex_float_steps(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns of doubles as the bits of base-16 floats; a null as the missing mark.

    In steps, so that each intermediate value is computed once.
    """
    def each(template: str) -> list[str]:
        return [template.format(n=n) + f" AS {n}" for n in names]

    others = [c for c in df.columns if c not in names]
    doubles = df.selectExpr(*others, *each("nanvl(CAST({n} AS DOUBLE), CAST(NULL AS DOUBLE))"))
    guessed = doubles.selectExpr(
        *others, *each("named_struct('v', {n}, 'a', abs({n}), 'g', CAST(floor(log2(abs({n})) / 4) AS INT) + 1)")
    )
    # log2 may be off by one ulp at powers of 16
    placed = guessed.selectExpr(
        *others,
        *each(
            "named_struct('v', {n}.v, 'a', {n}.a, 'e', {n}.g + CASE WHEN {n}.a >= pow(16D, {n}.g) THEN 1 "
            "WHEN {n}.a < pow(16D, {n}.g - 1) THEN -1 ELSE 0 END)"
        ),
    )
    mark = 0x2E << 56
    return placed.selectExpr(
        *others,
        *each(
            f"CASE WHEN {{n}}.v IS NULL THEN {mark}L WHEN {{n}}.v = 0 THEN 0L ELSE "
            "shiftleft(CAST({n}.e + 64 + CASE WHEN {n}.v < 0 THEN 128 ELSE 0 END AS BIGINT), 56) "
            "| CAST({n}.a * pow(2D, 56 - 4 * {n}.e) AS BIGINT) END"
        ),
    )


def bits_bytes(bits: Column, size: int = 8) -> Column:
    return F.unhex(F.lpad(F.hex(bits), 16, "0").substr(1, 2 * size))


def text_bytes(v: Column, size: int, encoded: bool = False) -> Column:
    b = v if encoded else F.encode(F.coalesce(v, F.lit("")), "UTF-8")
    too_long = F.raise_error(F.concat(F.lit(f"text of more than {size} bytes: "), F.hex(b))).cast("binary")
    return F.call_function("rpad", F.when(F.octet_length(b) > size, too_long).otherwise(b), F.lit(size), F.lit(b" "))


def transport_files(
    df: DataFrame,
    path: Column,
    order_by: Sequence[str],
    fields: Sequence[Field],
    label: str = "",
    member: str = "DATA",
    head: Callable[..., bytes] = header,
) -> DataFrame:
    """(``logical_path``, ``content``): one file per path, its rows in order. ``head`` decides on the layout."""
    texts = [f.name for f in fields if f.text]
    encoded = {n: df.schema[n].dataType == T.BinaryType() for n in texts}
    # The grouping needs this shuffle in any case; ahead of the encoding it also spreads that work.
    keyed = df.select(
        path.alias("logical_path"), F.struct(*order_by).alias("k"), *[F.col(f.name) for f in fields]
    ).repartition("logical_path")
    bits = hex_float_steps(keyed, [f.name for f in fields if not f.text])
    parts = [
        text_bytes(F.col(f.name), f.size, encoded[f.name]) if f.text else bits_bytes(F.col(f.name), f.size)
        for f in fields
    ]
    rows = bits.select("logical_path", "k", F.concat(*parts).alias("record"))
    data = rows.groupBy("logical_path").agg(
        F.expr("listagg(record, X'') WITHIN GROUP (ORDER BY k)").alias("data")
    )
    padded = F.call_function("rpad", F.col("data"), (F.ceil(F.length("data") / 80) * 80).cast("int"), F.lit(b" "))
    return data.select("logical_path", F.concat(F.lit(head(fields, member, label)), padded).alias("content"))
