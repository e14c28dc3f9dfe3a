"""Writes small tables as ``.sas7bdat`` bytes, so that tests and queries have files to read."""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from fixtures.transport import Field

# File magic and subheader signatures of 64-bit little-endian files.
MAGIC = bytes(12) + bytes.fromhex("c2ea8160b31411cfbd92080009c7318c181f1011")
ROW_SIZE = bytes.fromhex("f7f7f7f700000000")
COLUMN_SIZE = bytes.fromhex("f6f6f6f600000000")
COLUMN_TEXT = bytes.fromhex("fdffffffffffffff")
COLUMN_NAME = bytes.fromhex("ffffffffffffffff")
COLUMN_ATTRIBUTES = bytes.fromhex("fcffffffffffffff")
FORMAT_AND_LABEL = bytes.fromhex("fefbffffffffffff")
META, DATA, MIX = 0x0000, 0x0100, 0x0200
UTF8 = 20


def run_length(row: bytes) -> bytes:
    """Run-length encoding: repeats of 3 to 18 bytes, else copies of 1 to 16."""
    out, literal, i = bytearray(), bytearray(), 0

    def flush() -> None:
        for s in range(0, len(literal), 16):
            part = literal[s : s + 16]
            out.append(0x80 | (len(part) - 1))
            out.extend(part)
        literal.clear()

    while i < len(row):
        n = 1
        while n < 18 and i + n < len(row) and row[i + n] == row[i]:
            n += 1
        if n >= 3:
            flush()
            out.extend((0xC0 | (n - 3), row[i]))
        else:
            n = 1
            literal.append(row[i])
        i += n
    flush()
    return bytes(out)


def _record(fields: Sequence[Field], values: Sequence) -> bytes:
    out = b""
    for f, v in zip(fields, values):
        if f.text:
            out += ("" if v is None else v).encode().ljust(f.size)[: f.size]
        else:
            out += struct.pack("<d", math.nan if v is None else v)[8 - f.size :]
    return out


class _Page:
    """Subheaders grow from the end of a page, their pointers from its start."""

    def __init__(self, size: int):
        self.size, self.pointers, self.bodies, self.end = size, [], [], size

    def fits(self, body: bytes) -> bool:
        return self.end - len(body) - 8 >= 40 + 24 * (len(self.pointers) + 1)

    def add(self, body: bytes, flag: int = 0, sort: int = 0) -> None:
        self.end = (self.end - len(body)) // 8 * 8
        self.pointers.append(struct.pack("<QQBB6x", self.end, len(body), flag, sort))
        self.bodies.append((self.end, body))

    def room(self) -> int:
        return self.end - 40 - 24 * len(self.pointers)

    def bytes(self, kind: int, rows: bytes = b"", blocks: int = 0) -> bytes:
        page = bytearray(self.size)
        struct.pack_into("<HHH", page, 32, kind, blocks, len(self.pointers))
        front = b"".join(self.pointers) + rows
        page[40 : 40 + len(front)] = front
        for at, body in self.bodies:
            page[at : at + len(body)] = body
        return bytes(page)


def write_sas7bdat(
    fields: Sequence[Field], rows: Sequence[Sequence], page_size: int = 8192, compress: bool = False, mixed: bool = True
) -> bytes:
    text = bytearray(b"\0\0" + (b"SASYZCRL" if compress else b"\0" * 8) + bytes(16))

    def ref(s: str) -> tuple[int, int, int]:
        at = len(text)
        text.extend(s.encode())
        return 0, at, len(s.encode())

    names = [ref(f.name) for f in fields]
    formats = [ref(f.format) for f in fields]
    labels = [ref(f.label) for f in fields]
    struct.pack_into("<H", text, 0, len(text))
    row_length = sum(f.size for f in fields)
    records = [_record(fields, r) for r in rows]

    count = len(fields)
    column_name = COLUMN_NAME + bytes(8) + b"".join(struct.pack("<HHHH", *n, 0) for n in names) + bytes(12)
    column_name = column_name.ljust(28 + 8 * count, b"\0")
    attributes, at = COLUMN_ATTRIBUTES + bytes(8), 0
    for f in fields:
        attributes += struct.pack("<QIHBB", at, f.size, 0, 2 if f.text else 1, 0)
        at += f.size
    attributes += bytes(12)
    described = []
    for f, fmt, label in zip(fields, formats, labels):
        d = bytearray(64)
        d[:8] = FORMAT_AND_LABEL
        struct.pack_into("<HH", d, 24, f.width, f.decimals)
        struct.pack_into("<HHHHHH", d, 46, *fmt, *label)
        described.append(bytes(d))
    row_size = bytearray(808)
    row_size[:8] = ROW_SIZE
    struct.pack_into("<QQ", row_size, 40, row_length, len(records))
    struct.pack_into("<QQ", row_size, 72, count, 0)
    column_size = COLUMN_SIZE + struct.pack("<QQ", count, 0)
    bodies = [column_size, COLUMN_TEXT + bytes(text), column_name, attributes, *described]

    # Metadata pages; where rows start on the last of them, their number goes in the row size.
    page, pages = _Page(page_size), []
    page.add(bytes(row_size))
    for body in bodies:
        if not page.fits(body):
            pages.append(page)
            page = _Page(page_size)
        page.add(body, 0, 1)
    pages.append(page)
    out, left = [], records
    if compress:
        kinds = [META] * len(pages)
        out = [p.bytes(META) for p in pages[:-1]]
        page = pages[-1]
        for record in records:
            packed = run_length(record)
            body, flag = (packed, 4) if len(packed) < row_length else (record, 0)
            if not page.fits(body):
                out.append(page.bytes(META))
                page = _Page(page_size)
            page.add(body, flag, 1)
        out.append(page.bytes(META))
    else:
        on_mixed = min(len(records), pages[-1].room() // row_length) if mixed else 0
        first = pages[0]
        struct.pack_into("<Q", row_size, 120, on_mixed)
        first.bodies[0] = (first.bodies[0][0], bytes(row_size))
        out = [p.bytes(META) for p in pages[:-1]]
        if on_mixed:
            out.append(pages[-1].bytes(MIX, b"".join(records[:on_mixed]), on_mixed + len(pages[-1].pointers)))
        else:
            out.append(pages[-1].bytes(META))
        left = records[on_mixed:]
        per_page = (page_size - 40) // row_length
        for s in range(0, len(left), per_page):
            part = left[s : s + per_page]
            out.append(_Page(page_size).bytes(DATA, b"".join(part), len(part)))

    head = bytearray(8192)
    head[:32] = MAGIC
    head[32], head[35], head[37], head[39], head[70] = ord("3"), ord("2"), 1, ord("1"), UTF8
    struct.pack_into("<III", head, 196, len(head), page_size, len(out))
    return bytes(head) + b"".join(out)


def sas7bdat_files(
    df: DataFrame, path: Column, order_by: Sequence[str], fields: Sequence[Field], **options
) -> DataFrame:
    """(``logical_path``, ``content``): one file per path, a bounded number of rows each.

    An aggregate, so that a filter on the path is applied before any file is written.
    """
    names = [f.name for f in fields]

    @F.pandas_udf("binary")
    def write(*columns: pd.Series) -> bytes:
        rows = pd.concat(columns, axis=1, keys=names).sort_values(list(order_by)).astype(object)
        values = rows.where(rows.notna(), None).itertuples(index=False, name=None)
        return write_sas7bdat(fields, list(values), **options)

    keyed = df.select(path.alias("logical_path"), *[F.col(n).alias(f"_{i}") for i, n in enumerate(names)])
    return keyed.groupBy("logical_path").agg(write(*[F.col(f"_{i}") for i in range(len(names))]).alias("content"))
