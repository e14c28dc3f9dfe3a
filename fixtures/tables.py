"""What the queries read: the given tables, and files that Spark derives from them."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellframe.functions.bytes import code_page
from cellframe.sources.files import write_files
from fixtures.transport import Field, extended_header, header, transport_files

ROWS_PER_FILE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_path(name: str, key: str, extension: str = ".xpt", rows: int = ROWS_PER_FILE) -> Column:
    """Files of a bounded number of rows each; their number grows with the table."""
    number = F.floor(F.col(key) / rows).cast("bigint").cast("string")
    return F.concat(F.lit(f"{name}_"), number, F.lit(extension))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as files of every kind of name; none of them is a dataset."""
    endings = F.array(*[F.lit(e) for e in (".xpt", ".XPT", ".sas7bdat", ".txt", "")])
    name = F.concat(
        F.lit("page_"), F.col("page_id").cast("string"), F.get(endings, (F.col("page_id") % 5).cast("int"))
    )
    return table(spark, sf_dir, "pages").select(
        name.alias("logical_path"), F.encode("html", "UTF-8").alias("content")
    )


CUSTOMER_FIELDS = [
    Field("CUSTKEY", label="Customer key"),
    Field("NAME", 18, True, label="Customer name"),
    Field("NATION", 4, format="BEST", width=9, decimals=3),
    Field("ACCTBAL", label="Balance", width=9, decimals=3),
    Field("SEGMENT", 12, True, format="$CHAR", width=12),
]
CUSTOMER_LABEL = "Customers by key"
CUSTOMER_HEADER = len(header(CUSTOMER_FIELDS))
CUSTOMER_RECORD = sum(f.size for f in CUSTOMER_FIELDS)


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CUSTKEY"),
        F.col("c_name").alias("NAME"),
        F.col("c_nationkey").alias("NATION"),
        F.col("c_acctbal").alias("ACCTBAL"),
        F.col("c_mktsegment").alias("SEGMENT"),
    )


def customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transport_files(
        customer_rows(spark, sf_dir),
        part_path("customer", "CUSTKEY"),
        ["CUSTKEY"],
        CUSTOMER_FIELDS,
        CUSTOMER_LABEL,
        "CUST",
    )


ORDER_FIELDS = [
    Field("ORDERKEY"),
    Field("ODATE", format="DATE", width=9),
    Field("OYMD", 4, format="YYMMDD", width=10),
    Field("ODT", format="DATETIME"),
    Field("OTIME", format="TIME", width=8),
    Field("OTOD", format="TOD", width=8),
    Field("PRICE", format="best"),
    Field("STATUS", 1, True),
]

def order_days() -> Column:
    return F.datediff(F.col("o_orderdate").cast("date"), F.lit("1960-01-01").cast("date"))


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their dates and times as 1960-epoch numbers, some of them missing."""
    key = F.col("o_orderkey")
    days = order_days()
    seconds = days.cast("double") * 86400 + key % 86400
    return table(spark, sf_dir, "orders").select(
        key.alias("ORDERKEY"),
        F.when(key % 11 != 0, days).alias("ODATE"),
        days.alias("OYMD"),
        (seconds + 0.25).alias("ODT"),
        F.when(key % 7 != 0, F.when(key % 5 == 0, -1).otherwise(1) * (key % 200000)).alias("OTIME"),
        F.when(key % 13 != 0, seconds).alias("OTOD"),
        F.when(key % 3 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("PRICE"),
        F.col("o_orderstatus").alias("STATUS"),
    )


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transport_files(
        order_rows(spark, sf_dir), part_path("orders", "ORDERKEY"), ["ORDERKEY"], ORDER_FIELDS, "Orders"
    )


#: Names, labels and formats of ``ORDER_FIELDS`` that only the extended layout can hold.
LONG_ORDER_NAMES = {
    "ORDERKEY": ("Key_of_the_order_within_its_table", "The key by which an order is known to customers and to suppliers alike", ""),
    "ODATE": ("Order_date", "The day on which the order was placed, if it is known", "DATEAMPMLONG"),
    "OTIME": ("Order_time", "Time", "TIMEAMPMLONG"),
    "STATUS": ("Status", "", ""),
}


def long_order_fields() -> list[Field]:
    fields = []
    for f in ORDER_FIELDS:
        name, label, fmt = LONG_ORDER_NAMES.get(f.name, (f.name, f.label, ""))
        fields.append(replace(f, name=name[:32], label=label, format=fmt or f.format))
    return fields


def long_order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the extended layout, under a member name of more than eight characters."""
    fields = long_order_fields()
    rows = order_rows(spark, sf_dir).toDF(*[f.name for f in fields])
    path = part_path("orders", fields[0].name)
    return transport_files(rows, path, [fields[0].name], fields, "Orders", "ORDERS_OF_ALL_YEARS", extended_header)


#: Letters of customer names and what they become, which windows-1252 writes with other bytes than ISO-8859-1.
STRANGE_LETTERS = ("Custmer#", "\u20acü\u0161\u2122\u0153\u201e\u017e\u2026")


def windows_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with strange names in windows-1252; each seventh name has a byte that means nothing there."""
    found, meant, nothing = code_page("cp1252")
    written = F.encode(F.translate(F.translate("c_name", *STRANGE_LETTERS), meant, found), "ISO-8859-1")
    name = F.when(F.col("c_custkey") % 7 == 0, F.concat(written, F.lit(nothing[0].encode("latin-1")))).otherwise(written)
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CUSTKEY"), name.alias("NAME"))
    label = "Größe in €".encode("cp1252").decode("latin-1")
    fields = [Field("CUSTKEY"), Field("NAME", 20, True)]
    return transport_files(
        rows, part_path("customer", "CUSTKEY"), ["CUSTKEY"], fields, head=lambda f, member, _: header(f, member, label, text="latin-1")
    )


def written_folder(files: DataFrame) -> str:
    """The files in a new folder of the shared store, each written once."""
    spark = files.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/files-{uuid.uuid4().hex}"
    write_files(files, folder).agg(F.sum("length")).collect()
    return folder


def spoiled_customer_files(spark: SparkSession, sf_dir: str, kept: int) -> DataFrame:
    """Of each customer file four: whole, cut inside the record behind ``kept`` rows, without records, without a byte."""
    cut = CUSTOMER_HEADER + kept * CUSTOMER_RECORD + 5
    contents = ["content", f"substr(content, 1, {cut})", f"substr(content, 1, {CUSTOMER_HEADER})", "X''"]
    return customer_files(spark, sf_dir).selectExpr(
        "logical_path AS path", f"posexplode(array({', '.join(contents)})) AS (copy, content)"
    ).selectExpr("concat(copy, '/', path) AS logical_path", "content")
