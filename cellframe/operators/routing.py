"""Which files are dataset files, and of which format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cellframe.functions.formats import quoted
from cellframe.operators.errors import UNSUPPORTED_FILE, file_errors

# The supported file name endings.
XPT, SAS7BDAT = "xpt", "sas7bdat"


def file_format(path: Column) -> Column:
    """``xpt``, ``sas7bdat`` or null, from the ending of the name in any case."""
    lower = F.lower(path)
    return F.when(lower.endswith(f".{XPT}"), XPT).when(lower.endswith(f".{SAS7BDAT}"), SAS7BDAT)


def is_supported(path: Column) -> Column:
    return file_format(path).isNotNull()


def route(files: DataFrame) -> DataFrame:
    return files.withColumn("file_format", file_format(F.col("logical_path")))


def of_format(files: DataFrame, fmt: str) -> DataFrame:
    return files.filter(file_format(F.col("logical_path")) == fmt)


def unsupported_files(files: DataFrame) -> DataFrame:
    """Error rows for the other files; reads paths only, never their content."""
    path = F.col("logical_path")
    other = files.select("logical_path").filter(file_format(path).isNull() | path.isNull())
    return file_errors(other, f"concat({quoted(UNSUPPORTED_FILE)}, coalesce(logical_path, ''))")
