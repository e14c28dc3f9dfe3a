"""Checks and counts over cells and column dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Allowed characters and length of a column name.
NAME_PATTERN = "^[a-zA-Z0-9_]+$"
NAME_MAX_LENGTH = 32

_KEY = ["logical_path", "column_index"]
_COMPARED = ["column_name", "column_format", "data_type"]


def bad_name_characters(dictionary: DataFrame) -> DataFrame:
    """Dictionary rows whose column name has other characters than letters, digits, ``_``."""
    name = F.coalesce(F.col("column_name"), F.lit(""))
    # \z: in Java `$` also matches before a final line break
    return dictionary.filter(~name.rlike(NAME_PATTERN.replace("$", "\\z")))


def bad_name_length(dictionary: DataFrame, longest: int = NAME_MAX_LENGTH) -> DataFrame:
    return dictionary.filter(F.length("column_name") > longest)


def dictionary_differences(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Columns that are missing, extra, or differ in name, format or type."""
    a = actual.select(*_KEY, F.struct(*_COMPARED).alias("actual"))
    e = expected.select(*_KEY, F.struct(*_COMPARED).alias("expected"))
    joined = a.join(e, _KEY, "full_outer")
    return joined.filter(~F.col("actual").eqNullSafe(F.col("expected"))).select(
        *_KEY,
        *[F.col(f"actual.{c}").alias(f"actual_{c}") for c in _COMPARED],
        *[F.col(f"expected.{c}").alias(f"expected_{c}") for c in _COMPARED],
        _finding().alias("finding"),
    )


def dictionary_classes(dictionary: DataFrame) -> DataFrame:
    """(fingerprint, files, first_path, columns): the different dictionaries and how many files have each.

    A file's rows meet once, to be hashed; from then on files of one dictionary are counted before anything is shuffled,
    so it does not matter if nearly all files are alike. ``columns`` are in the order of their index. Rows without a
    column index (files that could not be read) belong to no dictionary.
    """
    return (
        _fingerprints(dictionary)
        .groupBy("fingerprint")
        .agg(F.count(F.lit(1)).alias("files"), F.min("logical_path").alias("first_path"),
             F.first("columns").alias("columns"))
    )


def dictionary_class_differences(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """The findings of ``dictionary_differences``, once for all files alike, with their number and the first path.

    Files are alike if both their actual and their expected dictionary are the same. Only one file of each class is
    compared, so the work grows with the files' fingerprints and not with files times columns. A file on one side only
    has all its columns missing or unexpected.
    """
    sides = [
        _fingerprints(df).withColumnsRenamed({"fingerprint": f"{side}_fingerprint", "columns": side})
        for side, df in (("actual", actual), ("expected", expected))
    ]
    classes = (
        sides[0].join(sides[1], "logical_path", "full_outer")
        .groupBy("actual_fingerprint", "expected_fingerprint")
        .agg(F.count(F.lit(1)).alias("files"), F.min("logical_path").alias("first_path"),
             F.first("actual").alias("actual"), F.first("expected").alias("expected"))
        .where("NOT actual_fingerprint <=> expected_fingerprint")
    )
    columns = classes.selectExpr(
        "files", "first_path",
        *[f"coalesce({side}, filter({other}, c -> false)) AS {side}"
          for side, other in (("actual", "expected"), ("expected", "actual"))],
    ).selectExpr(
        "*", "explode(array_union(transform(actual, c -> c.column_index), transform(expected, c -> c.column_index)))"
        " AS column_index",
    )
    compared = columns.selectExpr(
        "first_path", "files", "column_index",
        *[f"get(filter({side}, c -> c.column_index <=> column_index), 0) AS {side}" for side in ("actual", "expected")],
    )
    return compared.filter(~F.col("actual").eqNullSafe(F.col("expected"))).select(
        "first_path", "files", "column_index",
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("actual", "expected") for c in _COMPARED],
        _finding().alias("finding"),
    )


def _fingerprints(dictionary: DataFrame) -> DataFrame:
    """(logical_path, columns, fingerprint): one row per file, as large as its header."""
    column = F.struct("column_index", *_COMPARED)
    return (
        dictionary.where("column_index IS NOT NULL")
        .groupBy("logical_path")
        .agg(F.sort_array(F.collect_list(column)).alias("columns"))
        .withColumn("fingerprint", F.sha2(F.to_json("columns"), 256))
    )


def _finding() -> Column:
    return (
        F.when(F.col("actual").isNull(), "missing")
        .when(F.col("expected").isNull(), "unexpected")
        .otherwise("different")
    )


def cell_count(cells: DataFrame) -> DataFrame:
    """Emitted rows per dataset."""
    return cells.groupBy("logical_path").agg(F.count(F.lit(1)).alias("cells"))


def column_count(cells: DataFrame) -> DataFrame:
    """Columns per dataset; a dictionary works as well as cells."""
    return cells.groupBy("logical_path").agg((F.max("column_index") + 1).alias("columns"))


def sample_cells(cells: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows in a fixed order: a top-n, no full sort."""
    return cells.orderBy(
        *[F.col(c).asc_nulls_first() for c in ("logical_path", "row_index", "column_index")]
    ).limit(n)
