"""``.sas7bdat`` files: pages are spread over tasks, each decodes its own range.

The page codec is pandas'. What is here lets it start anywhere in a file: a range of
pages is decoded behind the file's own metadata pages, so a large file is as many
tasks as it has ranges. Text, dates and times are typed on the Spark side.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from cellframe.functions import values as V
from cellframe.functions.bytes import bound, none_if_blank, slice_bytes
from cellframe.functions.formats import (
    FORMAT_PREFIXES,
    Prefixes,
    format_text,
    is_time_of_day,
    quoted,
    type_from_format,
)
from cellframe.operators.errors import EMPTY_DATASET, ROW_FAILED, SAS_FAILED
from cellframe.schema import DOUBLE, STRING
from cellframe.sources.files import open_input, read_ranges
from cellframe.sources.xpt import typed_cells

RANGE_BYTES = 16 << 20
BLOCK_CELLS = 1 << 18

# Positions in the first bytes of a file.
_HEAD_SIZE, _WIDE_AT, _SHIFT_AT, _ORDER_AT, _SIZES_AT = 288, 32, 35, 37, 196
# Page kinds, and the marks of a subheader that holds a row.
_DATA, _MIX, _META_KINDS = 0x0100, 0x0200, (0x0000, 0x4000)
_ROW_FLAGS, _ROW_SORT = (0, 4), 1



def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_INT, _LONG, _TEXT = T.IntegerType(), T.LongType(), T.StringType()
_LAYOUT = _struct(
    file_error=_TEXT,
    head=T.BinaryType(),
    page_size=_LONG,
    prefix_end=_LONG,
    prefix_rows=_LONG,
    mixed_rows=_LONG,
    row_count=_LONG,
    range_rows=T.ArrayType(_LONG),
    columns=T.ArrayType(
        _struct(
            index=_INT, name=_TEXT, label=_TEXT, format_name=_TEXT, width=_INT, decimals=_INT, text=T.BooleanType()
        )
    ),
)
_BLOCK = _struct(
    logical_path=_TEXT,
    error=_TEXT,
    c=_struct(index=_INT, name=_TEXT, label=_TEXT, format=_TEXT, text=T.BooleanType()),
    first_row=_LONG,
    numbers=T.ArrayType(T.DoubleType()),
    texts=T.ArrayType(_TEXT),
)


class PageShape:
    """Byte order, word size and page size of a file: what is needed to walk its pages."""

    def __init__(self, head: bytes):
        if len(head) < _HEAD_SIZE:
            raise ValueError("the file ends inside its header")
        self.wide = head[_WIDE_AT] == ord("3")
        shift = 4 if head[_SHIFT_AT] == ord("3") else 0
        self.order = "<" if head[_ORDER_AT] == 1 else ">"
        self.header_size, self.page_size = struct.unpack_from(self.order + "II", head, _SIZES_AT + shift)
        self.word = 8 if self.wide else 4

    def subheaders(self, page: bytes) -> tuple[int, int, list[tuple[int, int, int, int]]]:
        """Page kind, its block count, and (offset, length, flag, sort) per subheader."""
        at = 32 if self.wide else 16
        kind, blocks, count = struct.unpack_from(self.order + "HHH", page, at)
        entry = struct.Struct(self.order + ("QQBB" if self.wide else "IIBB"))
        step = 3 * self.word
        return kind & 0xFF00, blocks, [entry.unpack_from(page, at + 8 + i * step) for i in range(count)]

    def known(self, page: bytes, offset: int) -> int | None:
        """Which kind of metadata a subheader is; None for a row."""
        from pandas._libs.sas import get_subheader_index
        from pandas.io.sas.sas_constants import SASIndex

        sort = get_subheader_index(bytes(page[offset : offset + self.word]))
        return None if sort == SASIndex.data_subheader_index else sort

    def rows(self, page: bytes, mixed_rows: int) -> int:
        kind, blocks, pointers = self.subheaders(page)
        if kind == _DATA:
            return blocks
        if kind == _MIX:
            return mixed_rows
        if kind not in _META_KINDS:
            return 0
        return sum(
            length > 0 and flag in _ROW_FLAGS and sort == _ROW_SORT and self.known(page, offset) is None
            for offset, length, flag, sort in pointers
        )

    def rows_in(self, pages: bytes, mixed_rows: int) -> int:
        view = memoryview(pages)
        starts = range(0, len(pages), self.page_size)
        return sum(self.rows(view[s : s + self.page_size], mixed_rows) for s in starts)


def _open(source) -> "pd.io.sas.sasreader.ReaderBase":
    reader = pd.read_sas(source, format="sas7bdat", encoding="infer", iterator=True)
    reader.convert_dates = False
    return reader


def read_layout(source, content: bytes | None = None, range_bytes: int = RANGE_BYTES) -> dict:
    """Columns and page layout of one open file; an unreadable one gives ``file_error``.

    With the whole ``content`` at hand, the rows of each range are counted as well.
    """
    from pandas.io.sas.sas_constants import SASIndex

    out = dict.fromkeys(_LAYOUT.names)
    try:
        head = source.read(_HEAD_SIZE)
        source.seek(0)
        reader = _open(source)
        prefix_end = source.tell()
        "".encode(reader.encoding)  # an encoding Python does not know is an error here
        shape = PageShape(head)
        source.seek(shape.header_size)
        prefix = source.read(prefix_end - shape.header_size)
        widths, mixed, rows_in_last = [], 0, 0
        for at in range(0, len(prefix), shape.page_size):
            page = prefix[at : at + shape.page_size]
            kind, _, pointers = shape.subheaders(page)
            for offset, length, *_ in pointers if kind != _DATA else ():
                sort = shape.known(page, offset) if length else None
                if sort == SASIndex.format_and_label_index:
                    widths.append(struct.unpack_from(shape.order + "HH", page, offset + 3 * shape.word))
                elif sort == SASIndex.row_size_index:
                    word = shape.order + ("Q" if shape.wide else "I")
                    (mixed,) = struct.unpack_from(word, page, offset + 15 * shape.word)
                    mixed = min(mixed, reader.row_count)
            rows_in_last = shape.rows(page, mixed)
        out.update(
            head=head,
            page_size=shape.page_size,
            prefix_end=prefix_end,
            prefix_rows=rows_in_last,
            mixed_rows=mixed,
            row_count=reader.row_count,
            columns=[
                {
                    "index": i,
                    "name": c.name,
                    "label": c.label,
                    "format_name": c.format,
                    "width": w,
                    "decimals": d,
                    "text": c.ctype == b"s",
                }
                for i, (c, (w, d)) in enumerate(zip(reader.columns, widths))
            ],
        )
        if content is not None:
            step = _pages_per_range(shape.page_size, range_bytes) * shape.page_size
            view = memoryview(content)
            out["range_rows"] = [
                shape.rows_in(view[at : at + step], mixed) for at in range(prefix_end, len(content), step)
            ]
        if reader.row_count == 0:
            out["file_error"] = EMPTY_DATASET
    except Exception as e:
        out["file_error"] = f"{SAS_FAILED}{e}"
    return out


def _pages_per_range(page_size: int, range_bytes: int) -> int:
    return max(1, range_bytes // page_size)


def _range_size(range_bytes: int) -> str:
    return f"(greatest(1L, {range_bytes} div page_size) * page_size)"


def scan_sas7bdat(
    files: DataFrame,
    *,
    prefixes: Prefixes = FORMAT_PREFIXES,
    range_bytes: int = RANGE_BYTES,
    spread: bool = True,
) -> DataFrame:
    """Cells and error rows of files given as (``logical_path``, ``content``)."""

    @F.pandas_udf(_LAYOUT)
    def layout(contents: pd.Series) -> pd.DataFrame:
        rows = [read_layout(io.BytesIO(c or b""), c or b"", range_bytes) for c in contents]
        return pd.DataFrame(rows, columns=_LAYOUT.names)

    laid = files.select("logical_path", "content", layout("content").alias("l")).select(
        "logical_path", "content", "l.*"
    )
    step = _range_size(range_bytes)
    # Files that cannot be read go along as one range without bytes: filters on the layout would make it anew for each side.
    ranges = bound(
        "if(file_error IS NULL, content, NULL)",
        "b",
        "transform(sequence(0, if(file_error IS NULL, greatest(size(range_rows), 1), 1) - 1), i -> "
        "named_struct('range', CAST(i AS BIGINT), "
        "'before', aggregate(slice(range_rows, 1, i), 0L, (n, r) -> n + r), "
        "'counted', coalesce(get(range_rows, i), 0L), "
        f"'body', {slice_bytes('b', f'prefix_end + i * {step}', step)}))",
    )
    placed = laid.selectExpr(
        "logical_path", "file_error", "columns", "prefix_rows", "row_count",
        f"if(file_error IS NULL, {slice_bytes('content', 0, 'prefix_end')}, NULL) AS prefix",
        "CAST(NULL AS STRING) AS body_error", f"inline({ranges})",
    )
    if spread:
        placed = placed.repartition("logical_path", "range")
    return _cells_of(placed, prefixes)


def scan_large_sas7bdat(
    listing: DataFrame,
    *,
    prefixes: Prefixes = FORMAT_PREFIXES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The same for files given as (``logical_path``, ``length``) in a shared store."""

    @F.pandas_udf(_LAYOUT)
    def layout(paths: pd.Series) -> pd.DataFrame:
        def one(path: str) -> dict:
            try:
                with open_input(path) as source:
                    return read_layout(source)
            except Exception as e:
                return dict.fromkeys(_LAYOUT.names) | {"file_error": f"{SAS_FAILED}{e}"}

        return pd.DataFrame([one(p) for p in paths], columns=_LAYOUT.names)

    @F.pandas_udf("bigint")
    def count_rows(heads: pd.Series, mixed: pd.Series, bodies: pd.Series) -> pd.Series:
        counts = [PageShape(h).rows_in(b, m) if b is not None else 0 for h, m, b in zip(heads, mixed, bodies)]
        return pd.Series(counts, dtype="int64")

    laid = listing.select("logical_path", "length", layout("logical_path").alias("l")).select(
        "logical_path", "length", "l.*"
    )
    step = _range_size(range_bytes)
    placed = (
        laid.filter("file_error IS NULL")
        .selectExpr("*", f"explode(sequence(0L, greatest((length - prefix_end - 1) div {step}, 0L))) AS range")
        .selectExpr("*", f"prefix_end + range * {step} AS offset", f"{step} AS size")
        .repartition("logical_path", "range")
    )
    # Rows per range, so that each range knows its first row; only counts are shuffled.
    counted = (
        read_ranges(placed, "body")
        .withColumn("counted", count_rows("head", "mixed_rows", "body"))
        .drop("body", "range_error", "head", "mixed_rows")
    )
    ranges = counted.selectExpr(
        "*",
        "coalesce(sum(counted) OVER (PARTITION BY logical_path ORDER BY range "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS before",
    ).repartition("logical_path", "range")
    bodies = read_ranges(ranges, "body").selectExpr(
        "* EXCEPT (offset, size, range_error)", "range_error AS first_error", "0L AS offset", "prefix_end AS size"
    )
    whole = read_ranges(bodies, "prefix").selectExpr("*", "coalesce(first_error, range_error) AS body_error")
    bad = laid.filter("file_error IS NOT NULL").select("logical_path", "file_error")
    return _cells_of(whole.unionByName(bad, allowMissingColumns=True), prefixes)


def _cells_of(ranges: DataFrame, prefixes: Prefixes) -> DataFrame:
    """Cells of ranges of pages, and an error row for each row with a ``file_error``."""
    columns = (
        "transform(columns, p -> named_struct('index', p.index, 'name', p.name, "
        f"'label', {none_if_blank('p.label')}, 'format', {format_text('p.format_name', 'p.width', 'p.decimals')}, "
        "'text', p.text))"
    )
    # The data page at the end of the metadata belongs to the first range.
    work = ranges.selectExpr(
        "logical_path", "file_error", f"{columns} AS columns", "prefix", "body", "row_count", "body_error",
        "CASE WHEN range = 0 THEN 0L ELSE prefix_rows END AS skip",
        "CASE WHEN range = 0 THEN 0L ELSE prefix_rows + before END AS first_row",
        "CASE WHEN range = 0 THEN prefix_rows + counted ELSE counted END AS rows",
    )
    blocks = work.mapInArrow(_decode_ranges, _BLOCK)
    logical = f"CASE WHEN c.text THEN {quoted(STRING)} ELSE {type_from_format('c.format', quoted(DOUBLE), prefixes)} END"
    typed = blocks.selectExpr(
        "logical_path", "error", "first_row",
        "CASE WHEN c IS NOT NULL THEN named_struct('index', c.index, 'name', c.name, 'label', c.label, "
        f"'format', c.format, 'type', {logical}, 'time_of_day', {is_time_of_day('c.format')}) END AS c",
        # arrays_zip of a null array is null; of an empty one it is padded with nulls
        "coalesce(numbers, CAST(array() AS ARRAY<DOUBLE>)) AS numbers",
        "coalesce(texts, CAST(array() AS ARRAY<STRING>)) AS texts",
    )
    values = typed.selectExpr(
        "logical_path", "error", "first_row", "c", "posexplode_outer(arrays_zip(numbers, texts)) AS (n, v)"
    )
    raw = values.selectExpr(
        "logical_path", "error", "CAST(NULL AS STRING) AS dataset_label", "first_row + n AS row", "c",
        f"{V.double('v.numbers')} AS number", "v.texts AS text",
    )
    return typed_cells(raw)


def _decode_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One output row per block of rows and column, its values as one array."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_BLOCK)

    def emit(path, error, column, first, values):
        text = column is not None and column["text"]
        number = column is not None and not text
        arrays = {
            "logical_path": [path],
            "error": [error],
            "c": [column],
            "first_row": [first],
            "numbers": [values if number else None],
            "texts": [values if text else None],
        }
        return pa.RecordBatch.from_arrays(
            [pa.array(arrays[f.name], f.type) for f in schema], schema=schema
        )

    for batch in batches:
        for r in batch.to_pylist():
            if r["file_error"] is not None:
                yield emit(r["logical_path"], r["file_error"], None, None, None)
                continue
            done, step = 0, max(1, BLOCK_CELLS // max(1, len(r["columns"])))
            try:
                if r["body_error"]:
                    raise OSError(r["body_error"])
                body, short = _whole_pages(r["prefix"], r["body"] or b"")
                rows = min(r["rows"], r["row_count"] - r["first_row"]) - short
                reader = None
                while done < rows:
                    try:
                        reader = reader or _reader_at(r["prefix"] + body, r["skip"] + done)
                        frame = reader.read(min(step, rows - done))
                        if frame.empty:
                            raise ValueError("fewer rows than the pages announce")
                    except Exception:
                        if step == 1:
                            raise
                        # the rows in front of the one that fails are found by halving
                        reader, step = None, max(1, min(step, rows - done) // 2)
                        continue
                    for i, column in enumerate(r["columns"]):
                        values = _values(frame, i, column, reader.encoding)
                        yield emit(r["logical_path"], None, column, r["first_row"] + done, values)
                    done += len(frame)
                if short or len(body) != len(r["body"] or b""):
                    raise ValueError("the file ends inside a page")
            except Exception as e:
                yield emit(r["logical_path"], f"{ROW_FAILED}{e}", None, None, None)


def _whole_pages(prefix: bytes, body: bytes) -> tuple[bytes, int]:
    """``body`` filled up to whole pages, and how many rows the page that was cut announces."""
    shape = PageShape(prefix[:_HEAD_SIZE])
    left = len(body) % shape.page_size
    if not left:
        return body, 0
    whole = body + bytes(shape.page_size - left)
    return whole, shape.rows(memoryview(whole)[len(whole) - shape.page_size:], 0)


def _reader_at(content: bytes, row: int):
    """A reader in front of a row, which leaves text as bytes: a bad byte then spoils its cell only."""
    reader = _open(io.BytesIO(content))
    reader.convert_text = False
    if row:
        reader.read(row)
    return reader


def _text(value, encoding: str) -> str | None:
    # blank text is text, not a missing value
    if not isinstance(value, bytes):
        return ""
    try:
        return value.decode(encoding)
    except UnicodeDecodeError:
        return None


def _values(frame: pd.DataFrame, i: int, column: dict, encoding: str) -> list[str | None] | np.ndarray:
    series = frame.iloc[:, i]
    if column["text"]:
        return [_text(v, encoding) for v in series]
    return series.to_numpy(dtype="float64")
