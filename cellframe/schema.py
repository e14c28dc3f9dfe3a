"""The two table contracts: files going in, typed cells coming out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FILE_SCHEMA = T.StructType(
    [
        T.StructField("logical_path", T.StringType()),
        T.StructField("content", T.BinaryType()),
    ]
)

# Field names, order and types of the output contract.
CELL_SCHEMA = T.StructType(
    [
        T.StructField("logical_path", T.StringType()),
        T.StructField("dataset_label", T.StringType()),
        T.StructField("row_index", T.IntegerType()),
        T.StructField("column_index", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("column_label", T.StringType()),
        T.StructField("column_format", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("value_string", T.StringType()),
        T.StructField("value_double", T.DoubleType()),
        T.StructField("value_date", T.DateType()),
        T.StructField("value_time", T.IntegerType()),
        T.StructField("value_timestamp", T.TimestampType()),
        T.StructField("error_msg", T.StringType()),
    ]
)

VALUE_SLOTS = {
    f.name: f.dataType for f in CELL_SCHEMA if f.name.startswith("value_")
}

STRING, DOUBLE, DATE, TIME, TIMESTAMP = "String", "Double", "Date", "Time", "Timestamp"


def ident(name: str) -> str:
    """A column name as SQL, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def conform(df: DataFrame, **expressions: str) -> DataFrame:
    """Select the 14 contract columns from SQL expressions; a typed null for the rest.

    The ``CASE`` has no other effect than a nullable result type, which the contract
    asks for; the optimizer reduces it to the value.
    """
    return df.selectExpr(
        *[
            f"CASE WHEN 1 = 1 THEN CAST({expressions.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) END"
            f" AS {f.name}"
            for f in CELL_SCHEMA
        ]
    )


def matches_contract(df: DataFrame) -> bool:
    return df.schema == CELL_SCHEMA
