"""In-band error rows. A bad file or cell becomes a row, never an exception."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellframe.functions.formats import quoted
from cellframe.schema import conform

# The error texts of the output contract.
UNSUPPORTED_FILE = "Unsupported SAS dataset (only .sas7bdat and .xpt supported): "
EMPTY_DATASET = "Empty SAS dataset"
XPT_FAILED = "Failed to read XPT file: "
SAS_FAILED = "Failed to parse SAS file: "
ROW_FAILED = "Failed to get next row: "
TOO_MANY_ROWS = "more rows than row_index can number"
VALUE_FAILED = "Failed to get value: "
TABLE_COUNT = "A single table in XPT-file is supported, found "


def file_errors(df: DataFrame, message: str) -> DataFrame:
    """One error row per row of ``df``: its path and the message, a SQL expression."""
    return conform(df, logical_path="logical_path", error_msg=message)


def data_rows(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("error_msg").isNull())


def error_rows(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("error_msg").isNotNull())


def empty_datasets(datasets: DataFrame, cells: DataFrame) -> DataFrame:
    """An error row for each dataset that yields no cell.

    The paths are made distinct before the join, so a dataset holding a large share
    of all cells reaches the join as one row per task, not as its cells.
    """
    seen = cells.select("logical_path").distinct()
    missing = datasets.select("logical_path").join(seen, "logical_path", "left_anti")
    return file_errors(missing, quoted(EMPTY_DATASET))
