"""The column dictionary of a Spark table: names, labels, formats, logical types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from cellframe.functions.formats import FORMAT_PREFIXES, TIME_OF_DAY_PREFIX, type_of_format
from cellframe.schema import DATE, DOUBLE, STRING, TIME, TIMESTAMP

DICTIONARY_SCHEMA = T.StructType(
    [
        T.StructField("logical_path", T.StringType()),
        T.StructField("dataset_label", T.StringType()),
        T.StructField("column_index", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("column_label", T.StringType()),
        T.StructField("column_format", T.StringType()),
        T.StructField("data_type", T.StringType()),
    ]
)


@dataclass(frozen=True)
class ColumnInfo:
    index: int
    name: str
    label: str | None
    format: str | None
    data_type: str | None
    physical: T.DataType

    @property
    def is_time_of_day(self) -> bool:
        return (self.format or "").upper().startswith(TIME_OF_DAY_PREFIX)


def type_of_physical(dtype: T.DataType) -> str | None:
    """Logical type of a Spark type; None for one that has no cell value."""
    if isinstance(dtype, (T.StringType, T.BooleanType)):
        return STRING
    if isinstance(dtype, T.NumericType):
        return DOUBLE
    if isinstance(dtype, T.DateType):
        return DATE
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return TIMESTAMP
    return None


def describe(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    labels: Mapping[str, str] | None = None,
    formats: Mapping[str, str] | None = None,
    prefixes: Sequence[tuple[str, str]] = FORMAT_PREFIXES,
) -> list[ColumnInfo]:
    """Dictionary entries of a table, in column order.

    Labels and formats come from the arguments, or else from the ``label`` and
    ``format`` keys of the field metadata. A format decides the type of numbers,
    dates and timestamps; text stays text.
    """
    labels, formats = labels or {}, formats or {}
    infos = []
    for index, name in enumerate(df.columns if columns is None else columns):
        field = df.schema[name]
        fmt = formats.get(field.name, field.metadata.get("format")) or None
        physical = type_of_physical(field.dataType)
        logical = physical
        if physical in (DOUBLE, DATE, TIMESTAMP):
            logical = type_of_format(fmt, prefixes) or physical
        infos.append(
            ColumnInfo(
                index=index,
                name=field.name,
                label=labels.get(field.name, field.metadata.get("label")) or None,
                format=fmt,
                data_type=logical,
                physical=field.dataType,
            )
        )
    return infos


def dictionary_of_datasets(
    datasets: DataFrame, infos: Sequence[ColumnInfo], label: str | None = None
) -> DataFrame:
    """The dictionary rows of each dataset named in ``datasets.logical_path``."""
    entries = F.array(
        *[
            F.struct(
                F.lit(i.index).alias("column_index"),
                F.lit(i.name).alias("column_name"),
                F.lit(i.label).cast("string").alias("column_label"),
                F.lit(i.format).cast("string").alias("column_format"),
                F.lit(i.data_type).cast("string").alias("data_type"),
            )
            for i in infos
        ]
    )
    return datasets.select(
        "logical_path", F.lit(label).cast("string").alias("dataset_label"), F.inline(entries)
    )
