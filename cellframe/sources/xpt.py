"""Transport (``.xpt``) files decoded with built-in SQL functions only.

The layout is the public transport record layout: 80-byte header records ("cards"),
one fixed-size descriptor per column, then fixed-size records padded with blanks to a
multiple of 80. The extended layout (version 8) has other card names, long names in its
descriptors, and records of varying length behind them for long labels and formats.
Positions below are 0-based byte offsets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cellframe.functions import values as V
from cellframe.functions.bytes import (
    bound,
    check_encoding,
    fixed_text,
    header_text,
    hex_float,
    hex_float_bits,
    latin1,
    none_if_blank,
    slice_bytes,
    unsigned,
)
from cellframe.functions.formats import (
    FORMAT_PREFIXES,
    Prefixes,
    format_text,
    is_time_of_day,
    quoted,
    type_from_format,
)
from cellframe.operators.errors import (
    EMPTY_DATASET,
    ROW_FAILED,
    TABLE_COUNT,
    TOO_MANY_ROWS,
    VALUE_FAILED,
    XPT_FAILED,
)
from cellframe.operators.quality import sample_cells
from cellframe.schema import DATE, DOUBLE, STRING, TIME, TIMESTAMP, conform
from cellframe.sources.files import list_files, open_input, read_ranges

# The record layout of transport files.
CARD = 80
MEMBER_AT, MEMBER_NAME_AT, LABEL_AT, COUNT_AT, COLUMNS_AT = 240, 408, 512, 614, 640
DESCRIPTOR_SIZE_AT = MEMBER_AT + 74
NUMBER_KIND, TEXT_KIND = 1, 2
# What the extended layout calls the cards, where it has what, and how many columns either can have.
EXTENDED_CARDS = {"LIBRARY": "LIBV8", "MEMBER": "MEMBV8", "NAMESTR": "NAMSTV8", "OBS": "OBSV8"}
LONG_NAME_AT, LONG_NAME_SIZE = 88, 32
MEMBER_NAME_SIZE = 8
MOST_COLUMNS, MOST_EXTENDED_COLUMNS = 9_999, 32_767
# A label record starts with 2-byte numbers: column, then sizes of its name, label, format and informat.
LABEL_CARDS = {"LABELV8": ("var", "name", "label"), "LABELV9": ("var", "name", "label", "format", "informat")}
#: Cards from the start of a member's header to the end of its name.
MEMBER_CARDS = 3
CUT_SHORT = "the file ends inside a record"
#: A message about more than one table names so many behind the first.
NAMED_MEMBERS = 100

CHUNK_BYTES = 1 << 20
LARGE_CHUNK_BYTES = 32 << 20
INT_MAX = 2**31 - 1

_NO_NAMES = "CAST(array() AS ARRAY<STRING>)"


def _card_text(name: str) -> bytes:
    return f"HEADER RECORD*******{name:<8}HEADER RECORD!!!!!!!".encode("ascii")


def _card(name: str) -> str:
    return f"X'{_card_text(name).hex()}'"


def _card_of(name: str) -> str:
    """The card of that role in the layout of the file, told by ``extended``."""
    return f"CASE WHEN extended THEN {_card(EXTENDED_CARDS[name])} ELSE {_card(name)} END"


def _is_card(at: str | int, card: str, content: str = "head") -> str:
    return f"coalesce({slice_bytes(content, at, 48)} = {card}, false)"


_EXTENDED = _is_card(0, _card(EXTENDED_CARDS["LIBRARY"]))
_MEMBER_NAME_SIZE = f"CASE WHEN extended THEN {LONG_NAME_SIZE} ELSE {MEMBER_NAME_SIZE} END"


def scan_xpt(
    files: DataFrame,
    *,
    encoding: str = "UTF-8",
    prefixes: Prefixes = FORMAT_PREFIXES,
    chunk_bytes: int = CHUNK_BYTES,
    spread: bool = True,
) -> DataFrame:
    """Cells and error rows of files given as (``logical_path``, ``content``).

    A file is cut into chunks of whole records before its bytes grow into cells.
    ``spread`` shuffles the chunks, so that one large file is decoded by many tasks.
    """
    heads = read_headers(_whole_heads(files, "content"), encoding, prefixes)
    later = slice_bytes("content", "records_at", "file_length - records_at")
    more = f"CASE WHEN contains(later, {_card_of('MEMBER')}) THEN {_member_names('later')} END"
    heads = (
        heads.selectExpr("*", f"CASE WHEN file_error IS NULL THEN {later} END AS later")
        .selectExpr("*", f"coalesce({more}, {_NO_NAMES}) AS found")
        .selectExpr("*", f"slice(found, 1, {NAMED_MEMBERS}) AS extra", "CAST(size(found) AS BIGINT) AS more")
        .selectExpr("* EXCEPT (later, found)")
    )
    heads = _with_table_count(heads)
    with_bytes = bound(
        "content",
        "b",
        f"transform({_chunk_ranges(chunk_bytes)}, c -> named_struct('first_row', c.first_row, 'rows', c.rows, "
        f"'error', c.error, 'bytes', {slice_bytes('b', 'c.offset', 'c.size')}))",
    )
    chunks = _fixed(heads, chunks=with_bytes).selectExpr(
        "logical_path", "dataset_label", "columns", "record_size", "inline(chunks)"
    )
    if spread:
        chunks = chunks.repartition("logical_path", "first_row")
    return decode_records(chunks, encoding)


def scan_large_xpt(
    listing: DataFrame,
    *,
    encoding: str = "UTF-8",
    prefixes: Prefixes = FORMAT_PREFIXES,
    chunk_bytes: int = LARGE_CHUNK_BYTES,
) -> DataFrame:
    """The same for files given as (``logical_path``, ``length``) in a shared store.

    Reads a file's header, then hands out byte ranges, so a file of any size is
    decoded by as many tasks as it has chunks and its content never sits in one row.
    """
    heads = read_headers(_fetched_heads(listing), encoding, prefixes)
    # Later members can only be found by looking: one pass over the record bytes,
    # reduced to the names found, almost always none, before anything is shuffled.
    # The ranges are whole cards up to the end of the file, whatever the size of a record, and each reaches far enough
    # behind its end to hold the name of a member whose header starts inside it.
    step = max(1, chunk_bytes // CARD) * CARD
    searched = heads.filter("file_error IS NULL AND file_length > records_at").selectExpr(
        "logical_path", "extended", f"explode(sequence(records_at, file_length - 1, {step}L)) AS offset",
        f"least(file_length - offset, {step + CARD * MEMBER_CARDS}L) AS size",
    )
    looked = read_ranges(searched.repartition("logical_path", "offset"))
    extra = (
        looked.filter(f"contains(bytes, {_card_of('MEMBER')})")
        .selectExpr("logical_path", "offset", f"posexplode({_member_names('bytes', step)}) AS (n, name)")
        .groupBy("logical_path")
        .agg(F.count("n").alias("more"),
             F.slice(F.sort_array(F.collect_list(F.struct("offset", "n", "name"))), 1, NAMED_MEMBERS).alias("named"))
        .selectExpr("logical_path", "transform(named, m -> m.name) AS extra", "more")
    )
    heads = _with_table_count(
        heads.join(extra, "logical_path", "left").selectExpr(
            "* EXCEPT (extra, more)", f"coalesce(extra, {_NO_NAMES}) AS extra", "coalesce(more, 0L) AS more"
        )
    )
    return _decode_ranges(heads, encoding, chunk_bytes)


def _decode_ranges(heads: DataFrame, encoding: str, chunk_bytes: int) -> DataFrame:
    """Cells and error rows of files of which the headers are known, read by ranges of bytes."""
    spread = _fixed(heads, ranges=_chunk_ranges(chunk_bytes)).selectExpr(
        "logical_path", "dataset_label", "columns", "record_size", "inline(ranges)"
    ).repartition("logical_path", "first_row")
    chunks = (
        read_ranges(spread)
        .selectExpr(
            "* EXCEPT (error, range_error)", f"coalesce(error, {quoted(ROW_FAILED)} || range_error) AS error"
        )
        .selectExpr("* EXCEPT (rows)", "CASE WHEN error IS NULL THEN rows ELSE 0 END AS rows")
    )
    return decode_records(chunks, encoding)


def dictionary(files: DataFrame, encoding: str = "UTF-8", prefixes: Prefixes = FORMAT_PREFIXES) -> DataFrame:
    """The column dictionary of each readable file; record bytes are not decoded."""
    heads = read_headers(_whole_heads(files), encoding, prefixes)
    return _dictionary_of(heads).where("column_index IS NOT NULL").drop("error_msg")


def dictionary_errors(files: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """(logical_path, error_msg) of the files that have no readable dictionary."""
    heads = read_headers(_whole_heads(files), encoding, FORMAT_PREFIXES)
    return _dictionary_of(heads).where("error_msg IS NOT NULL").select("logical_path", "error_msg")


def read_dictionary(
    spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", prefixes: Prefixes = FORMAT_PREFIXES
) -> DataFrame:
    """The column dictionaries of all transport files below ``path``, with a row (path, error_msg) for each bad file.

    Only the headers are fetched, so files of any size cost the same.
    """
    return _dictionary_of(read_headers(_fetched_heads(list_files(spark, path, ".xpt")), encoding, prefixes))


def read_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(logical_path, n_rows, n_columns, cells, error_msg) of all transport files below ``path``, from headers and lengths.

    No record is read: the length and the last card of a file tell its rows. The error is that of the file, or says that
    it ends inside a record, which does not take the rows before that. Later members are not looked for.
    """
    heads = read_headers(_fetched_heads(list_files(spark, path, ".xpt")), "ISO-8859-1", FORMAT_PREFIXES)
    cut = f"CASE WHEN cut_short THEN {quoted(ROW_FAILED + CUT_SHORT)} END"
    return heads.selectExpr(
        "logical_path", "CASE WHEN file_error IS NULL THEN rows ELSE 0L END AS n_rows",
        "coalesce(size(columns), 0) AS n_columns", f"coalesce(file_error, {cut}) AS error_msg",
    ).selectExpr("logical_path", "n_rows", "n_columns", "n_rows * n_columns AS cells", "error_msg")


def read_first(
    spark: SparkSession, path: str | list[str], n: int, encoding: str = "UTF-8", prefixes: Prefixes = FORMAT_PREFIXES
) -> DataFrame:
    """The first ``n`` rows, in the order of ``sample_cells``, of the cells of all transport files below ``path``.

    Headers and lengths tell where these rows lie, so no other records are read. Later members are not looked for.
    """
    # Each file has a row at least, so no file behind the first n paths is opened.
    listing = list_files(spark, path, ".xpt").orderBy("logical_path").limit(n).repartition("logical_path")
    heads = _first_rows(read_headers(_fetched_heads(listing), encoding, prefixes), n)
    return sample_cells(_decode_ranges(heads, encoding, LARGE_CHUNK_BYTES), n)


def _first_rows(heads: DataFrame, n: int) -> DataFrame:
    """The files that hold the first ``n`` rows of cells, their ``rows`` cut to what is needed; at most n files go in.

    An error row of a file comes in front of its cells.
    """
    earlier = Window.orderBy("logical_path").rowsBetween(Window.unboundedPreceding, -1)
    sized = heads.selectExpr(
        "*", "greatest(coalesce(size(columns), 0), 1) AS width",
        "CASE WHEN file_error IS NOT NULL OR cut_short THEN 1L ELSE 0L END AS errors",
    ).selectExpr("*", "errors + CASE WHEN file_error IS NULL THEN rows * width ELSE 0L END AS emitted")
    placed = sized.withColumn("before", F.coalesce(F.sum("emitted").over(earlier), F.lit(0))).where(F.col("before") < n)
    needed = f"(greatest({n}L - before - errors, 0L) + width - 1) div width"
    return placed.selectExpr("* EXCEPT (rows, width, errors, emitted, before)", f"least(rows, {needed}) AS rows")


def _dictionary_of(heads: DataFrame) -> DataFrame:
    # a file without records has a dictionary all the same
    bad = f"CASE WHEN file_error <> {quoted(EMPTY_DATASET)} THEN file_error END"
    return heads.selectExpr("logical_path", "dataset_label", f"{bad} AS error_msg", "columns").selectExpr(
        "logical_path", "dataset_label", "error_msg", "inline_outer(CASE WHEN error_msg IS NULL THEN columns END)"
    ).selectExpr(
        "logical_path", "CASE WHEN error_msg IS NULL THEN dataset_label END AS dataset_label",
        "index AS column_index", "name AS column_name", "label AS column_label", "format AS column_format",
        "type AS data_type", "error_msg",
    )


# --- headers -----------------------------------------------------------------


def _fixed(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` with columns that are worked out once: the optimizer copies no expression through a generator.

    Otherwise every mention of a column in a later step would become a copy of all that leads to it, and a filter on
    what a header says would grow beyond what can be planned.
    """
    parts = ", ".join(f"'{name}', {expression}" for name, expression in columns.items())
    return df.selectExpr("*", f"inline(array(named_struct({parts})))")


def _whole_heads(files: DataFrame, *kept: str) -> DataFrame:
    """The head and tail of whole contents, cut out before anything else looks at them."""
    front = files.selectExpr(
        "logical_path", "content", f"substr(content, 1, {COLUMNS_AT}) AS head",
        f"substr(content, greatest(length(content) - {CARD - 1}, 1)) AS tail",
        "CAST(length(content) AS BIGINT) AS file_length", "CAST(NULL AS STRING) AS failure",
    )
    told = _fixed(_fixed(front, extended=_EXTENDED), described=f"coalesce({_head_size()}, {COLUMNS_AT})")
    labelled = f"CASE WHEN extended THEN {bound('content', 'b', _labels_end('b', 'described'))} END"
    return _fixed(told, head_size=f"CAST(coalesce({labelled}, described) AS INT)").selectExpr(
        "logical_path", *kept, "substr(content, 1, head_size) AS head", "tail", "file_length", "failure"
    )


def _fetched_heads(listing: DataFrame) -> DataFrame:
    """The head and tail of files given as (``logical_path``, ``length``) in a shared store; each is opened once."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, lengths = (batch.column(c).to_pylist() for c in ("logical_path", "length"))
            rows = []
            for path, length in zip(paths, lengths):
                try:
                    with open_input(path) as source:
                        rows.append((*read_head(source, length), None))
                except Exception as e:
                    rows.append((None, None, f"{XPT_FAILED}{type(e).__name__}: {e}"))
            heads, tails, failures = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("logical_path"), pa.array(heads, pa.binary()), pa.array(tails, pa.binary()),
                 batch.column("length"), pa.array(failures, pa.string())],
                names=["logical_path", "head", "tail", "file_length", "failure"],
            )

    return listing.select("logical_path", "length").mapInArrow(
        fetch, "logical_path string, head binary, tail binary, file_length long, failure string"
    )


def read_head(source: BinaryIO, length: int) -> tuple[bytes, bytes]:
    """The bytes in front of the first record, as far as they make sense, and the last card of a file."""

    def number(at: int, size: int, of: bytes) -> int:
        text = of[at:at + size].strip()
        return int(text) if text.isdigit() else -1

    def is_card(card: bytes, name: str) -> bool:
        return card.startswith(_card_text(name))

    head = source.read(COLUMNS_AT)
    extended = is_card(head, EXTENDED_CARDS["LIBRARY"])
    size = number(DESCRIPTOR_SIZE_AT, 4, head)
    count = number(COUNT_AT - 1, 5, head) if extended else number(COUNT_AT, 4, head)
    if 88 <= size <= 200 and 0 <= count <= (MOST_EXTENDED_COLUMNS if extended else MOST_COLUMNS):
        head += source.read(-(-size * count // CARD) * CARD + CARD)
        for name, fields in LABEL_CARDS.items() if extended else ():
            if is_card(head[-CARD:], name):
                start, at = len(head), len(head)
                for _ in range(number(48, 5, head[-CARD:])):
                    while len(head) < at + 2 * len(fields) and (more := source.read(1 << 16)):
                        head += more
                    sizes = head[at + 2:at + 2 * len(fields)]
                    at += 2 * len(fields) + sum(int.from_bytes(sizes[i:i + 2], "big") for i in range(0, len(sizes), 2))
                end = start + -(-(at - start) // CARD) * CARD + CARD
                head += source.read(max(0, end - len(head)))
                head = head[:end]
                break
    source.seek(max(0, length - CARD))
    return head, source.read(CARD)


def _descriptor_size() -> str:
    size = _ascii_int(DESCRIPTOR_SIZE_AT)
    return f"CASE WHEN {size} BETWEEN 88 AND 200 THEN {size} END"


def _column_count() -> str:
    count = f"CASE WHEN extended THEN {_ascii_int(COUNT_AT - 1, 5)} ELSE {_ascii_int(COUNT_AT)} END"
    most = f"CASE WHEN extended THEN {MOST_EXTENDED_COLUMNS} ELSE {MOST_COLUMNS} END"
    return f"CASE WHEN {count} BETWEEN 0 AND {most} THEN {count} END"


def _head_size() -> str:
    """Bytes up to the end of the card behind the descriptors; null unless both counts make sense."""
    return f"CAST({_records_card(_descriptor_size(), _column_count())} + {CARD} AS INT)"


def _ascii_int(at: str | int, size: int = 4, content: str = "head") -> str:
    return f"try_cast(trim({latin1(slice_bytes(content, at, size))}) AS INT)"


def _records_card(size: str, count: str) -> str:
    """Where the card behind the descriptors is, which are padded."""
    end = f"({COLUMNS_AT} + {size} * {count})"
    return f"(({end} + {CARD - 1}) div {CARD} * {CARD})"


def _number_at(b: str, at: str) -> str:
    return unsigned(slice_bytes(b, at, 2))


def _label_steps(b: str, at: str, start: str, then: str, last: str) -> str:
    """Walks the label records behind the card that ends at ``at``; null if that is no label card, or what it says is none.

    A record tells its own size, so each starts where the sizes before it add up to. ``then`` makes the next state of
    the state ``p``, whose place is ``last``, out of the record's size ``{size}``.
    """
    count = _ascii_int(f"{at} - {CARD - 48}", 5, b)
    cases = ""
    for card, fields in LABEL_CARDS.items():
        sizes = " + ".join(_number_at(b, f"{last} + {2 * i}") for i in range(1, len(fields)))
        walk = f"aggregate(sequence(1, {count}), {start}, (p, i) -> {then.format(size=f'{2 * len(fields)} + {sizes}')})"
        sensible = f"WHEN {count} BETWEEN 1 AND {MOST_EXTENDED_COLUMNS} THEN {walk} WHEN {count} = 0 THEN {start}"
        cases += f" WHEN {_is_card(f'{at} - {CARD}', _card(card), b)} THEN CASE {sensible} END"
    return f"(CASE{cases} END)"


def _labels_end(b: str, at: str) -> str:
    """The end of the card in front of the records, if label records come before it."""
    end = _label_steps(b, at, f"CAST({at} AS BIGINT)", "p + {size}", "p")
    return f"(({end} - {at} + {CARD - 1}) div {CARD} * {CARD} + {at} + {CARD})"


def _labels(at: str, encoding: str) -> str:
    """What the label records say: an array of (var, name, label, format)."""
    places = _label_steps(
        "h", at, f"array(CAST({at} AS BIGINT))", "concat(p, array(element_at(p, -1) + {size}))", "element_at(p, -1)"
    )
    kinds = ""
    for card, fields in LABEL_CARDS.items():
        read = {f: _number_at("h", f"p + {2 * i}") for i, f in enumerate(fields)}
        sizes = ", ".join(f"'{f}', {read.get(f, '0L')}" for f in ("var", "name", "label", "format"))
        texts, start = "", f"s.p + {2 * len(fields)}"
        for f in ("name", "label", "format"):
            texts += f", '{f}', {none_if_blank(header_text(slice_bytes('h', start, f's.{f}'), encoding))}"
            start += f" + s.{f}"
        each = f"transform(slice(places, 1, size(places) - 1), p -> named_struct('p', p, {sizes}))"
        made = f"transform({each}, s -> named_struct('var', s.var{texts}))"
        kinds += f" WHEN {_is_card(f'{at} - {CARD}', _card(card), 'h')} THEN {made}"
    return bound("head", "h", bound(places, "places", f"CASE{kinds} END"))


def read_headers(files: DataFrame, encoding: str, prefixes: Prefixes) -> DataFrame:
    """Add label, columns, record layout and ``file_error`` to (head, tail, file_length).

    ``failure`` says why a file could not be fetched. Nothing here depends on the
    number of records, so it is one small row per file.
    """
    check_encoding(encoding)
    sized = _fixed(
        _fixed(files, extended=_EXTENDED), descriptor_size=_descriptor_size(), column_count=_column_count()
    )
    # label records lie between the descriptors and the last card of an extended head
    card_at = f"CASE WHEN extended THEN length(head) - {CARD} ELSE {_records_card('descriptor_size', 'column_count')} END"
    reasons = [
        ("head IS NULL", "no content"),
        (f"NOT {_is_card(0, _card_of('LIBRARY'))}", "not a transport file"),
        (f"file_length <= {MEMBER_AT}", f"{TABLE_COUNT}0: "),
        (f"NOT {_is_card(MEMBER_AT, _card_of('MEMBER'))}", "no member header"),
        (f"NOT {_is_card(COLUMNS_AT - CARD, _card_of('NAMESTR'))}", "no column descriptors"),
        ("descriptor_size IS NULL OR column_count IS NULL", "bad column count"),
        (f"NOT {_is_card(card_at, _card_of('OBS'))}", "no observation header"),
    ]
    refused = " ".join(f"WHEN {test} THEN {quoted(XPT_FAILED + why)}" for test, why in reasons)
    checked = _fixed(
        sized, records_at=f"CAST({card_at} + {CARD} AS BIGINT)",
        file_error=f"CASE WHEN failure IS NOT NULL THEN failure {refused} END",
        described=f"{_records_card('descriptor_size', 'column_count')} + {CARD}",
    )
    label = none_if_blank(header_text(slice_bytes("head", LABEL_AT, 40), encoding))
    labels = _labels("described", encoding)
    read = _fixed(checked, labels=f"CASE WHEN extended AND file_error IS NULL THEN {labels} END")
    described = read.selectExpr(
        "* EXCEPT (described)",
        f"CASE WHEN file_error IS NULL AND column_count > 0 THEN {_columns(encoding, prefixes)} END AS columns",
        f"CASE WHEN file_error IS NULL THEN {label} END AS dataset_label",
        f"{header_text(slice_bytes('head', MEMBER_NAME_AT, _MEMBER_NAME_SIZE), encoding)} AS first_name",
    ).selectExpr("*", "aggregate(columns, 0L, (n, c) -> n + c.size) AS record_size")
    misplaced = (
        f"exists(columns, c -> c.size < 1 OR c.at + c.size > record_size OR "
        f"(c.kind = {NUMBER_KIND} AND c.size NOT BETWEEN 2 AND 8))"
    )
    laid_out = described.selectExpr(
        "* EXCEPT (head, file_error, failure, descriptor_size, column_count, labels)",
        f"CASE WHEN file_error IS NOT NULL THEN file_error WHEN {misplaced} "
        f"THEN {quoted(XPT_FAILED + 'bad column descriptors')} END AS file_error",
    )
    return _count_records(laid_out)


def _columns(encoding: str, prefixes: Prefixes) -> str:
    """The column dictionary: an array of one struct per descriptor."""

    def part(at: int, size: int) -> str:
        return slice_bytes("d", at, size)

    def text(at: int, size: int) -> str:
        return header_text(part(at, size), encoding)

    raw = bound(
        "head",
        "h",
        "transform(sequence(0, column_count - 1), i -> "
        f"{slice_bytes('h', f'{COLUMNS_AT} + i * descriptor_size', 'descriptor_size')})",
    )
    long_name = none_if_blank(text(LONG_NAME_AT, LONG_NAME_SIZE))
    parts = (
        f"transform({raw}, (d, i) -> named_struct('index', i, "
        f"'name', coalesce(CASE WHEN extended THEN {long_name} END, {text(8, 8)}), "
        "'more', get(filter(labels, r -> r.var = i + 1), 0), "
        f"'label', {none_if_blank(text(16, 40))}, 'format_name', {text(56, 8)}, "
        f"'width', {unsigned(part(64, 2))}, 'decimals', {unsigned(part(66, 2))}, "
        f"'kind', {unsigned(part(0, 2))}, 'size', {unsigned(part(4, 2))}, 'at', {unsigned(part(84, 4))}))"
    )
    written = (
        f"transform({parts}, p -> named_struct('index', p.index, 'name', coalesce(p.more.name, p.name), "
        f"'label', coalesce(p.more.label, p.label), "
        f"'format', coalesce(p.more.format, {format_text('p.format_name', 'p.width', 'p.decimals')}), "
        f"'kind', p.kind, 'size', p.size, 'at', p.at))"
    )
    number = type_from_format("p.format", quoted(DOUBLE), prefixes)
    return (
        f"transform({written}, p -> named_struct('index', p.index, 'name', p.name, 'label', p.label, "
        f"'format', p.format, 'type', CASE p.kind WHEN {TEXT_KIND} THEN {quoted(STRING)} WHEN {NUMBER_KIND} THEN {number} END, "
        f"'time_of_day', {is_time_of_day('p.format')}, 'kind', p.kind, 'size', p.size, 'at', p.at))"
    )


def _count_records(heads: DataFrame) -> DataFrame:
    """Number of whole records, blank padding not counted.

    Padding fills the last 80 bytes, so all-blank records within the last 79 bytes
    are padding, and what is left behind the last whole record must be blank.
    """
    data = "CASE WHEN file_error IS NULL THEN greatest(file_length - records_at, 0L) END AS data"
    tail = latin1("tail")
    counted = (
        heads.selectExpr("*", data, "nullif(record_size, 0L) AS step")
        .selectExpr("*", f"data - least(length({tail}) - length(rtrim({tail})), {CARD - 1}, data) AS used")
        .selectExpr(
            "*", "(used + step - 1) div step AS touched", "data div step AS whole",
            # the least number of records whose padding is less than a card
            f"CASE WHEN data >= {CARD} THEN (data - {CARD}) div step + 1 ELSE 0L END AS least_rows",
        )
        .selectExpr(
            "* EXCEPT (tail, data, step, used, touched, whole, least_rows)",
            "coalesce(least(whole, greatest(touched, least_rows)), 0L) AS rows",
            "coalesce(touched > whole, false) AS cut_short",
        )
    )
    found = f"CASE WHEN file_error IS NOT NULL THEN file_error WHEN rows = 0 AND NOT cut_short THEN {quoted(EMPTY_DATASET)} END"
    return _fixed(counted, found=found).selectExpr("* EXCEPT (file_error, found)", "found AS file_error")


def _member_names(b: str, within: int | None = None) -> str:
    """Names of the members whose header starts at a card boundary of ``b``, in its first ``within`` bytes."""
    last = f"length(b) div {CARD} - 1"
    if within is not None:
        last = f"least({last}, {within // CARD - 1})"
    cards = f"sequence(0, CAST(greatest({last}, 0L) AS INT))"
    name = slice_bytes("b", f"i * {CARD} + {MEMBER_NAME_AT - MEMBER_AT}", _MEMBER_NAME_SIZE)
    found = f"filter({cards}, i -> {_is_card(f'i * {CARD}', _card_of('MEMBER'), 'b')})"
    return bound(b, "b", f"transform({found}, i -> rtrim({latin1(name)}))")


def _with_table_count(heads: DataFrame) -> DataFrame:
    """Whether ``more`` tables than one were found is an error of the file."""
    told = _fixed(heads, told=f"coalesce(file_error, {_table_count_error()})")
    return told.selectExpr("* EXCEPT (file_error, told)", "told AS file_error")


def _table_count_error() -> str:
    """The number of tables, and the names of the first ones in file order."""
    names = f"concat_ws(', ', array(first_name), extra), CASE WHEN more > {NAMED_MEMBERS} THEN ', ...' ELSE '' END"
    return (
        f"CASE WHEN more > 0 THEN concat({quoted(XPT_FAILED + TABLE_COUNT)}, "
        f"CAST(more + 1 AS STRING), ': ', {names}) END"
    )


def _chunk_ranges(chunk_bytes: int) -> str:
    """Ranges of whole records; a file error is a range of its own, and so is a cut end.

    A range is a multiple of both record and card size, so a card never straddles two.
    """
    step = f"(greatest(1L, {chunk_bytes} div record_size div {CARD}) * {CARD})"
    rows = f"least({step}, rows - i * {step})"
    whole = (
        f"transform(sequence(0L, (rows - 1) div {step}), i -> named_struct('first_row', i * {step}, "
        f"'rows', CAST({rows} AS INT), 'offset', records_at + i * {step} * record_size, "
        f"'size', {rows} * record_size, 'error', CAST(NULL AS STRING)))"
    )

    def failed(message: str) -> str:
        return (
            "array(named_struct('first_row', -1L, 'rows', 0, 'offset', 0L, 'size', 0L, "
            f"'error', CAST({message} AS STRING)))"
        )

    cut = failed(quoted(ROW_FAILED + CUT_SHORT))
    return (
        f"CASE WHEN file_error IS NOT NULL THEN {failed('file_error')} WHEN cut_short AND rows = 0 THEN {cut} "
        f"WHEN cut_short THEN concat({whole}, {cut}) ELSE {whole} END"
    )


# --- records -----------------------------------------------------------------


def decode_records(chunks: DataFrame, encoding: str) -> DataFrame:
    """Chunks of records to cells; a chunk that only carries an error becomes its row."""
    cut = f"transform(sequence(0, rows - 1), i -> {slice_bytes('b', 'i * record_size', 'record_size')})"
    records = f"CASE WHEN rows > 0 THEN {bound('bytes', 'b', cut)} END"
    rows = chunks.selectExpr(
        "logical_path", "dataset_label", "columns", "error", "first_row",
        f"posexplode_outer({records}) AS (n, record)",
    )
    cells = rows.selectExpr(
        "logical_path", "dataset_label", "error", "first_row + n AS row", "record",
        "explode_outer(CASE WHEN n IS NOT NULL THEN columns END) AS c",
    )
    fields = cells.selectExpr(
        "logical_path", "CASE WHEN c IS NOT NULL THEN dataset_label END AS dataset_label", "error", "row", "c",
        f"{slice_bytes('record', 'c.at', 'c.size')} AS field",
    )
    raw = fields.selectExpr(
        "*",
        f"CASE WHEN c.kind = {TEXT_KIND} THEN {fixed_text('field', encoding)} END AS text",
        f"CASE WHEN c.kind = {NUMBER_KIND} THEN {hex_float_bits('field')} END AS bits",
    )
    unsupported = "CASE WHEN c IS NOT NULL AND c.type IS NULL THEN concat('Unsupported data type ', CAST(c.kind AS STRING)) END"
    numbers = raw.selectExpr("* EXCEPT (error)", f"{hex_float('bits')} AS number", f"coalesce(error, {unsupported}) AS error")
    return typed_cells(numbers, encoding)


def typed_cells(raw: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Raw text and numbers into the slot of their column's logical type."""
    timed = raw.selectExpr(
        "*",
        f"CASE WHEN c.type <> {quoted(TIME)} THEN NULL WHEN c.time_of_day THEN {V.seconds_to_time_of_day('number')} "
        f"ELSE {V.seconds_to_time('number')} END AS seconds",
    )

    def when(logical: str, value: str) -> str:
        return f"CASE WHEN c.type = {quoted(logical)} THEN {value} END"

    unnumbered = f"CASE WHEN row > {INT_MAX} THEN {quoted(ROW_FAILED + TOO_MANY_ROWS)} END"
    spoiled = quoted(f"{VALUE_FAILED}the bytes are not {encoding} text")
    return conform(
        timed,
        logical_path="logical_path",
        dataset_label="dataset_label",
        row_index=f"CASE WHEN row <= {INT_MAX} THEN row END",
        column_index="c.index",
        column_name="c.name",
        column_label="c.label",
        column_format="c.format",
        data_type="c.type",
        value_string=f"CASE WHEN c.type = {quoted(STRING)} THEN text "
        f"WHEN c.type = {quoted(TIME)} THEN {V.time_text('seconds')} END",
        value_double=when(DOUBLE, "number"),
        value_date=when(DATE, V.days_to_date("number")),
        value_time="seconds",
        value_timestamp=when(TIMESTAMP, V.seconds_to_timestamp("number")),
        error_msg=f"coalesce(error, CASE WHEN c.type = {quoted(STRING)} AND text IS NULL THEN {spoiled} END, {unnumbered})",
    )
