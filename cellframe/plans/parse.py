"""Files or tables in, one table of typed cells and error rows out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellframe.functions.formats import FORMAT_PREFIXES, quoted
from cellframe.operators.cells import to_cells
from cellframe.operators.errors import SAS_FAILED, XPT_FAILED, empty_datasets, file_errors
from cellframe.operators.routing import SAS7BDAT, XPT, of_format, unsupported_files
from cellframe.sources.files import list_files, read_whole
from cellframe.sources.sas7bdat import scan_large_sas7bdat, scan_sas7bdat
from cellframe.sources.xpt import scan_large_xpt, scan_xpt

#: Larger files are not read into one row but by byte ranges. Both give the same rows, from the same file system.
WHOLE_FILE_BYTES = 64 << 20


def parse_files(
    files: DataFrame,
    *,
    encoding: str = "UTF-8",
    prefixes: Sequence[tuple[str, str]] = FORMAT_PREFIXES,
    spread: bool = True,
) -> DataFrame:
    """Cells of all files of a (``logical_path``, ``content``) table.

    Each file stands alone: one that cannot be read becomes an error row. ``spread``
    shuffles a file's chunks so that large files do not bind one task.
    """
    return (
        scan_xpt(of_format(files, XPT), encoding=encoding, prefixes=prefixes, spread=spread)
        .unionByName(scan_sas7bdat(of_format(files, SAS7BDAT), prefixes=prefixes, spread=spread))
        .unionByName(unsupported_files(files))
    )


def read_files(
    spark: SparkSession,
    path: str | list[str],
    *,
    encoding: str = "UTF-8",
    prefixes: Sequence[tuple[str, str]] = FORMAT_PREFIXES,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
    datasets_where: str | None = None,
) -> DataFrame:
    """Cells of all files below ``path``: files, folders, patterns. A file without a byte is an error row as well.

    Files whose ``logical_path`` does not fulfil the SQL condition ``datasets_where`` are listed, but not opened.

    Up to ``whole_file_bytes`` a file is one row and one task's work; beyond that its byte ranges are spread over the
    cluster.
    """
    options = {"prefixes": prefixes}

    def listed() -> DataFrame:
        files = list_files(spark, path)
        return files if datasets_where is None else files.select("logical_path", "length").where(datasets_where)

    parts = [unsupported_files(listed())]
    for fmt, failed, whole, large, extra in (
        (XPT, XPT_FAILED, scan_xpt, scan_large_xpt, {"encoding": encoding}),
        (SAS7BDAT, SAS_FAILED, scan_sas7bdat, scan_large_sas7bdat, {}),
    ):
        files = of_format(listed(), fmt)
        small = read_whole(files.filter(F.col("length") <= whole_file_bytes))
        parts.append(whole(small.where("read_error IS NULL"), spread=False, **options, **extra))
        parts.append(file_errors(small.where("read_error IS NOT NULL"), f"concat({quoted(failed)}, read_error)"))
        parts.append(large(files.filter(F.col("length") > whole_file_bytes), **options, **extra))
    cells = parts[0]
    for part in parts[1:]:
        cells = cells.unionByName(part)
    return cells


def parse_table(df: DataFrame, logical_path: str, **options) -> DataFrame:
    """Cells of one table; like an empty file, an empty table gives one error row, if the filters of ``to_cells`` let it."""
    cells = to_cells(df, logical_path, **options)
    # One column and one row are enough to tell whether there are any.
    first = df.select(F.lit(logical_path).alias("logical_path")).limit(1)
    dataset = df.sparkSession.range(1).select(F.lit(logical_path).alias("logical_path"))
    errors = empty_datasets(dataset, first)
    for condition in ("columns_where", "datasets_where"):
        if options.get(condition) is not None:
            errors = errors.where(options[condition])
    return cells.unionByName(errors)
