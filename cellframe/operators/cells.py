"""The wide-to-long pivot of a Spark table into typed cells."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from cellframe.functions import values as V
from cellframe.functions.formats import FORMAT_PREFIXES, quoted
from cellframe.operators.dictionary import DICTIONARY_SCHEMA, ColumnInfo, describe
from cellframe.operators.errors import ROW_FAILED, TOO_MANY_ROWS
from cellframe.operators.row_index import with_row_index
from cellframe.schema import CELL_SCHEMA, DATE, DOUBLE, STRING, TIME, TIMESTAMP, VALUE_SLOTS, conform, ident


_MICROS = {
    T.TimestampType: V.micros_of_instant,
    T.TimestampNTZType: V.micros_of_local,
    T.DateType: V.micros_of_date,
}


def to_cells(
    df: DataFrame,
    logical_path: str | Column,
    *,
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    row_index: str | None = None,
    dataset_label: str | None = None,
    labels: Mapping[str, str] | None = None,
    formats: Mapping[str, str] | None = None,
    prefixes: Sequence[tuple[str, str]] = FORMAT_PREFIXES,
    rows_per_bucket: int = 1_000_000,
    bucket_by: Sequence[str] | None = None,
    columns_where: str | None = None,
    datasets_where: str | None = None,
) -> DataFrame:
    """One row per cell of ``df``: rows x columns, missing values included.

    ``logical_path`` names the dataset; as a Column it cuts the table into datasets.
    Rows are numbered by the existing column ``row_index``, or else in the order of
    ``order_by`` within each dataset. ``columns`` picks what is pivoted; filters
    cannot move below the pivot by themselves, so this is what lets Parquet skip the other columns.
    ``columns_where`` and ``datasets_where`` are filters over the result that are applied below the pivot: the former
    an SQL condition on what describes a column (``column_index`` to ``data_type``), answered from the dictionary, the
    latter on ``logical_path``, before rows are numbered. The cells are those of the whole result that fulfil both,
    with the numbers they have there.
    ``bucket_by``, a leading part of ``order_by``, makes numbering cheaper, see ``with_row_index``.
    Rows past 32 bits keep their cells, with a null index and an error.
    """
    if (row_index is None) == (order_by is None):
        raise ValueError("give either row_index or order_by")
    if columns is None:
        columns = [c for c in df.columns if c != row_index]
    infos = describe(df, columns, labels, formats, prefixes)
    if not infos:
        raise ValueError("no columns to pivot")
    if columns_where is not None:
        infos = _columns_that(df.sparkSession, infos, columns_where)
        columns = [i.name for i in infos]
    one_dataset = isinstance(logical_path, str)
    path = F.lit(logical_path) if one_dataset else logical_path
    if datasets_where is None:
        df = df.withColumn("_path", path)
    else:  # packed, as the table may have a column of that name itself
        packed = df.select(F.struct(*map(ident, df.columns)).alias("_row"), path.alias("logical_path"))
        df = packed.where(datasets_where).select("_row.*", F.col("logical_path").alias("_path"))
    if not infos:
        return df.sparkSession.createDataFrame([], CELL_SCHEMA)
    if row_index is None:
        row_index = "_row_index"
        needed = dict.fromkeys(["_path", *columns, *order_by])
        dataset_by = [] if one_dataset else ["_path"]
        df = with_row_index(
            df.select(*map(ident, needed)), order_by, dataset_by, row_index, rows_per_bucket, bucket_by=bucket_by
        )
        return pivot(df, infos, "_path", row_index, dataset_label, f"{ROW_FAILED}{TOO_MANY_ROWS}")
    return pivot(df, infos, "_path", row_index, dataset_label)


def _columns_that(spark: SparkSession, infos: Sequence[ColumnInfo], condition: str) -> list[ColumnInfo]:
    """The columns whose dictionary entry fulfils an SQL condition; as few rows as the table has columns."""
    names = ["column_index", "column_name", "column_label", "column_format", "data_type"]
    fields = T.StructType([f for f in DICTIONARY_SCHEMA if f.name in names])
    entries = spark.createDataFrame([(i.index, i.name, i.label, i.format, i.data_type) for i in infos], fields)
    kept = {r.column_index for r in entries.where(condition).collect()}
    return [i for i in infos if i.index in kept]


def pivot(
    df: DataFrame,
    infos: Sequence[ColumnInfo],
    path: str,
    row_index: str,
    dataset_label: str | None = None,
    unnumbered: str | None = None,
) -> DataFrame:
    """Pivot rows that already carry their path and row index.

    The values of one slot (all doubles, all strings, ...) are put side by side in
    an array, once per row; the only exploded thing is the column number, which
    then looks up its metadata and its value. Built-in ``unpivot`` needs one common
    value type, and an array of structs per row costs twice the time. ``unnumbered`` is
    the error of cells without a row index.
    """
    values = [_slots(i) for i in infos]
    arrays, places = {}, {}
    for slot in VALUE_SLOTS:
        held = [n for n, v in enumerate(values) if slot in v]
        if held:
            arrays[slot] = f"array({', '.join(values[n][slot] for n in held)}) AS _{slot}"
            places[slot] = {n: p for p, n in enumerate(held)}

    numbers = range(len(infos))
    exploded = df.selectExpr(path, f"{ident(row_index)} AS _row", *arrays.values()).selectExpr(
        "*", f"explode(array({', '.join(map(str, numbers))})) AS _column"
    )

    def lookup(entries: Sequence[str]) -> str:
        if len(set(entries)) == 1:
            return entries[0]
        return f"get(array({', '.join(entries)}), _column)"

    def texts(entries: Iterable[str | None]) -> str:
        return lookup(["CAST(NULL AS STRING)" if e is None else quoted(e) for e in entries])

    def value(slot: str) -> str:
        at = [str(places[slot].get(n, "CAST(NULL AS INT)")) for n in numbers]
        return f"get(_{slot}, {lookup(at)})"

    return conform(
        exploded,
        logical_path=path,
        dataset_label="NULL" if dataset_label is None else quoted(dataset_label),
        row_index="_row",
        column_index=lookup([str(i.index) for i in infos]) if any(i.index != n for n, i in enumerate(infos)) else "_column",
        column_name=texts(i.name for i in infos),
        column_label=texts(i.label for i in infos),
        column_format=texts(i.format for i in infos),
        data_type=texts(i.data_type for i in infos),
        error_msg=texts(_unsupported(i) for i in infos) if unnumbered is None else
        f"coalesce({texts(_unsupported(i) for i in infos)}, CASE WHEN _row IS NULL THEN {quoted(unnumbered)} END)",
        **{slot: value(slot) for slot in arrays},
    )


def _unsupported(info: ColumnInfo) -> str | None:
    if info.data_type is None:
        return f"Unsupported data type {info.physical.simpleString()}"
    return None


def _slots(info: ColumnInfo) -> dict[str, str]:
    """The value slots a column fills, by its logical and physical type."""
    v = ident(info.name)
    micros = next((to(v) for kind, to in _MICROS.items() if isinstance(info.physical, kind)), None)
    if info.data_type == STRING:
        return {"value_string": V.text(v)}
    if info.data_type == DOUBLE:
        return {"value_double": V.double(v)}
    if info.data_type == DATE:
        if isinstance(info.physical, T.DateType):
            return {"value_date": v}
        return {"value_date": V.micros_to_date(micros) if micros else V.days_to_date(v)}
    if info.data_type == TIMESTAMP:
        return {"value_timestamp": V.micros_to_timestamp(micros) if micros else V.seconds_to_timestamp(v)}
    if info.data_type == TIME:
        if micros:
            seconds = V.micros_to_time_of_day(micros)
        elif info.is_time_of_day:
            seconds = V.seconds_to_time_of_day(v)
        else:
            seconds = V.seconds_to_time(v)
        return {"value_string": V.time_text(seconds), "value_time": seconds}
    return {}
