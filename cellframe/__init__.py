"""Dataset files and tables as one long table of typed cells, on Spark."""

from cellframe.operators.cells import to_cells
from cellframe.operators.errors import data_rows, error_rows
from cellframe.plans.parse import parse_files, parse_table, read_files
from cellframe.schema import CELL_SCHEMA, FILE_SCHEMA, matches_contract

__all__ = [
    "CELL_SCHEMA",
    "FILE_SCHEMA",
    "data_rows",
    "error_rows",
    "matches_contract",
    "parse_files",
    "parse_table",
    "read_files",
    "to_cells",
]
