"""Every query of the engine, next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import cellframe as cf
from cellframe.functions import values as V
from cellframe.functions.formats import type_from_format
from cellframe.operators import quality, routing
from cellframe.operators.dictionary import describe, dictionary_of_datasets
from cellframe.operators.errors import empty_datasets
from cellframe.operators.row_index import with_row_index
from cellframe.sources import files, xpt
from fixtures import tables as X
from fixtures.sas7bdat import sas7bdat_files
from fixtures.tables import table
from fixtures.transport import Field, transport_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Small enough that the check tables already use several buckets.
ROWS_PER_BUCKET = 25_000


def query(sql: str | None = None, name: str | None = None):
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


# --- SQL building blocks ------------------------------------------------------

SLOT_TYPES = {
    "value_string": "VARCHAR",
    "value_double": "DOUBLE",
    "value_date": "DATE",
    "value_time": "INTEGER",
    "value_timestamp": "TIMESTAMP",
}
TIME_TEXT = (
    "CASE WHEN {s} IS NULL THEN NULL ELSE (CASE WHEN {s} < 0 THEN '-' ELSE '' END) || "
    "printf('%02d:%02d:%02d', abs({s}) // 3600, abs({s}) // 60 % 60, abs({s}) % 60) END"
)


def quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def sql_row(path: str, error: str = "NULL", label: str = "NULL", row: str = "NULL", index="NULL",
            name=None, column_label=None, fmt=None, data_type=None, **slots: str) -> str:
    """The select list of one output row."""
    values = ", ".join(f"CAST({slots.get(s, 'NULL')} AS {t}) AS {s}" for s, t in SLOT_TYPES.items())
    return (
        f"{path} AS logical_path, CAST({label} AS VARCHAR) AS dataset_label, "
        f"CAST({row} AS INTEGER) AS row_index, CAST({index} AS INTEGER) AS column_index, "
        f"CAST({quoted(name)} AS VARCHAR) AS column_name, CAST({quoted(column_label)} AS VARCHAR) AS column_label, "
        f"CAST({quoted(fmt)} AS VARCHAR) AS column_format, CAST({quoted(data_type)} AS VARCHAR) AS data_type, "
        f"{values}, CAST({error} AS VARCHAR) AS error_msg"
    )


# (name, label, format, type, {slot: SQL expression})
ColumnSql = tuple[str, str | None, str | None, str | None, dict[str, str]]


def cells_sql(rows: str, path: str, order: str, columns: list[ColumnSql], label: str | None = None,
              where: str = "true", datasets: str | None = None, errors: dict[int, str] | None = None) -> str:
    """One branch per column over the numbered rows."""
    partition = f"PARTITION BY {datasets} " if datasets else ""
    branches = [
        "SELECT "
        + sql_row(path, row="rn - 1", index=str(i), label=quoted(label), name=n, column_label=lab, fmt=fmt,
                  data_type=t, error=(errors or {}).get(i, "NULL"), **slots)
        + f" FROM numbered WHERE {where}"
        for i, (n, lab, fmt, t, slots) in enumerate(columns)
    ]
    numbered = f"SELECT *, row_number() OVER ({partition}ORDER BY {order}) AS rn FROM ({rows})"
    return f"WITH numbered AS MATERIALIZED ({numbered}) " + " UNION ALL ".join(branches)


def plain(name: str, kind: str) -> ColumnSql:
    slot = {"Double": "value_double", "String": "value_string", "Timestamp": "value_timestamp"}[kind]
    return (name, None, None, kind, {slot: name})


D, S, TS = "Double", "String", "Timestamp"
TABLE_COLUMNS = {
    "customer": [("c_custkey", D), ("c_name", S), ("c_nationkey", D), ("c_acctbal", D), ("c_mktsegment", S)],
    "orders": [("o_orderkey", D), ("o_custkey", D), ("o_orderstatus", S), ("o_totalprice", D),
               ("o_orderdate", TS), ("o_orderpriority", S)],
    "lineitem": [("l_orderkey", D), ("l_partkey", D), ("l_suppkey", D), ("l_linenumber", D), ("l_quantity", D),
                 ("l_extendedprice", D), ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                 ("l_linestatus", S), ("l_shipdate", TS)],
    "events": [("event_id", D), ("ts", TS), ("user_id", D), ("event_type", S), ("value", D), ("props", S)],
}
ORDER = {
    "customer": ["c_custkey"],
    "orders": ["o_orderkey"],
    # not unique on (l_orderkey, l_linenumber)
    "lineitem": [c for c, _ in TABLE_COLUMNS["lineitem"]],
    "events": ["event_id"],
}


def table_cells(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    # no value of the first key is more than a handful of rows
    return cf.to_cells(
        table(spark, sf_dir, name), name, order_by=ORDER[name], bucket_by=ORDER[name][:1],
        rows_per_bucket=ROWS_PER_BUCKET, **options,
    )


def table_cells_sql(name: str, columns: list[str] | None = None) -> str:
    kinds = dict(TABLE_COLUMNS[name])
    chosen = [(c, kinds[c]) for c in columns or kinds]
    return cells_sql(f"SELECT * FROM {name}", quoted(name), ", ".join(ORDER[name]), [plain(*c) for c in chosen])


# --- tables to cells ----------------------------------------------------------


def _register_tables() -> None:
    for name in TABLE_COLUMNS:

        def run(spark: SparkSession, sf_dir: str, name: str = name) -> DataFrame:
            return table_cells(spark, sf_dir, name)

        query(table_cells_sql(name), f"cells_{name}")(run)


_register_tables()
PRUNED = ["o_orderdate", "o_orderstatus"]


@query(table_cells_sql("orders", PRUNED))
def cells_pruned(spark, sf_dir):
    """Two columns of a table with a unique key: the scan reads these and the key."""
    return table_cells(spark, sf_dir, "orders", columns=PRUNED)


FILTERED_COLUMNS = "column_name IN ('o_orderdate', 'o_totalprice') AND data_type <> 'String'"
FILTERED_DATASETS = "logical_path = 'orders_1-URGENT' OR endswith(logical_path, 'LOW')"


@query(
    "SELECT * FROM ("
    + cells_sql("SELECT * FROM orders", "'orders_' || o_orderpriority", "o_orderkey",
                [plain(*c) for c in TABLE_COLUMNS["orders"]], datasets="o_orderpriority")
    + ") WHERE column_name IN ('o_orderdate', 'o_totalprice') AND logical_path IN ('orders_1-URGENT', 'orders_5-LOW')"
)
def cells_filtered(spark, sf_dir):
    """Filters over cells that reach the scan: other columns are not read, other datasets not numbered."""
    path = F.concat(F.lit("orders_"), F.col("o_orderpriority"))
    return cf.to_cells(
        table(spark, sf_dir, "orders"), path, columns=[c for c, _ in TABLE_COLUMNS["orders"]], order_by=["o_orderkey"],
        rows_per_bucket=ROWS_PER_BUCKET, columns_where=FILTERED_COLUMNS, datasets_where=FILTERED_DATASETS,
    )


@query(
    "SELECT CAST(row_number() OVER (ORDER BY o_orderstatus = 'F' OR o_orderkey % 10 <> 0 DESC, o_orderkey) - 1 AS INTEGER)"
    " AS row_index, o_orderkey FROM orders"
)
def row_index_heavy_value(spark, sf_dir):
    """Numbers where nearly all rows have one value in the column that cuts them into buckets."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderstatus = 'F' OR o_orderkey % 10 <> 0 THEN 0 ELSE 1 END AS part"
    )
    return with_row_index(rows, ["part", "o_orderkey"], rows_per_bucket=ROWS_PER_BUCKET, bucket_by=["part"]).drop("part")


@query(
    cells_sql(
        "SELECT *, date_diff('day', DATE '1960-01-01', o_orderdate::DATE) AS days FROM orders",
        "'orders'",
        "o_orderkey",
        [
            ("o_orderkey", "Order key", None, "Double", {"value_double": "o_orderkey"}),
            ("days", "Order date", "DATE9.", "Date", {"value_date": "o_orderdate::DATE"}),
            ("o_orderdate", None, "TOD8.", "Time", {"value_time": "0", "value_string": "'00:00:00'"}),
            ("o_orderstatus", None, "$CHAR1.", "String", {"value_string": "o_orderstatus"}),
        ],
        "All orders",
    )
)
def cells_formatted(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("days", X.order_days())
    return cf.to_cells(
        orders, "orders", columns=["o_orderkey", "days", "o_orderdate", "o_orderstatus"], order_by=["o_orderkey"],
        dataset_label="All orders", labels={"o_orderkey": "Order key", "days": "Order date"},
        formats={"days": "DATE9.", "o_orderdate": "TOD8.", "o_orderstatus": "$CHAR1."},
        rows_per_bucket=ROWS_PER_BUCKET,
    )


@query(
    "SELECT o_orderkey, o_orderpriority, CAST(row_number() OVER (PARTITION BY o_orderpriority "
    "ORDER BY o_orderkey) - 1 AS INTEGER) AS row_index FROM orders"
)
def row_index_per_dataset(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return with_row_index(orders, ["o_orderkey"], ["o_orderpriority"], rows_per_bucket=ROWS_PER_BUCKET)


@query(
    "WITH n AS (SELECT 'orders_' || o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1) "
    f"SELECT p AS logical_path, n * {len(TABLE_COLUMNS['orders'])} AS cells FROM n"
)
def cell_count(spark, sf_dir):
    return quality.cell_count(_orders_by_priority(spark, sf_dir))


@query(
    "SELECT DISTINCT 'orders_' || o_orderpriority AS logical_path, "
    f"CAST({len(TABLE_COLUMNS['orders'])} AS INTEGER) AS columns FROM orders"
)
def column_count(spark, sf_dir):
    return quality.column_count(_orders_by_priority(spark, sf_dir))


def _orders_by_priority(spark, sf_dir):
    path = F.concat(F.lit("orders_"), F.col("o_orderpriority"))
    return cf.to_cells(
        table(spark, sf_dir, "orders"), path, columns=[c for c, _ in TABLE_COLUMNS["orders"]],
        order_by=["o_orderkey"], rows_per_bucket=ROWS_PER_BUCKET,
    )


@query(
    "SELECT * FROM (" + table_cells_sql("orders") + ") ORDER BY logical_path, row_index, column_index LIMIT 100"
)
def sample_cells(spark, sf_dir):
    return quality.sample_cells(table_cells(spark, sf_dir, "orders"), 100)


_COUNTS = ", ".join(f"count({s}) AS n_{s[6:]}" for s in SLOT_TYPES)


@query(
    f"SELECT data_type, count(*) AS n, {_COUNTS}, count(error_msg) AS n_errors FROM ("
    + table_cells_sql("events")
    + ") GROUP BY data_type"
)
def schema_contract(spark, sf_dir):
    """The 14 fields, and that a type fills its own slot and no other."""
    cells = table_cells(spark, sf_dir, "events")
    if not cf.matches_contract(cells):
        raise AssertionError(f"schema differs from the contract: {cells.schema.simpleString()}")
    return cells.groupBy("data_type").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(s).alias(f"n_{s[6:]}") for s in SLOT_TYPES],
        F.count("error_msg").alias("n_errors"),
    )


@query(
    cells_sql(
        "SELECT * FROM embeddings", "'embeddings'", "vec_id",
        [plain("vec_id", D), ("embedding", None, None, None, {}), plain("label", D)],
        errors={1: "'Unsupported data type array<float>'"},
    )
)
def err_unsupported_type(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return cf.to_cells(vectors, "embeddings", order_by=["vec_id"], rows_per_bucket=ROWS_PER_BUCKET)


@query(
    "SELECT " + sql_row("'customer_' || c_custkey", "'Empty SAS dataset'") + " FROM customer "
    "WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_custkey % 3 <> 0)"
)
def err_empty(spark, sf_dir):
    def path(key):
        return F.concat(F.lit("customer_"), F.col(key).cast("string"))

    # customers whose number is a multiple of three have no orders in this collection
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").where("o_custkey % 3 <> 0")
    cells = cf.to_cells(
        orders, path("o_custkey"), columns=["o_orderkey"], order_by=["o_orderkey"], rows_per_bucket=ROWS_PER_BUCKET
    )
    datasets = table(spark, sf_dir, "customer").select(path("c_custkey").alias("logical_path"))
    return empty_datasets(datasets, cells)


# --- metadata -----------------------------------------------------------------

# Formats of every kind, and null.
FORMATS = ["DATE9.", "date7.", "DATETIME.", "DATETIME20.", "DT8601.", "TIME5.", "HHMM.", "TOD8.", "YYMMDD10.",
           "BEST9.3", "9.3", "$CHAR8.", None]
_RULE = (
    "CASE WHEN upper(f) LIKE 'DATETIME%' OR upper(f) LIKE 'DT%' THEN 'Timestamp' "
    "WHEN upper(f) LIKE 'DATE%' OR upper(f) LIKE 'YYMMDD%' THEN 'Date' "
    "WHEN upper(f) LIKE 'TIME%' OR upper(f) LIKE 'HHMM%' OR upper(f) LIKE 'TOD%' THEN 'Time' ELSE 'Double' END"
)


@query(
    f"SELECT p_partkey, f AS column_format, {_RULE} AS data_type FROM (SELECT p_partkey, "
    f"list_extract([{', '.join(quoted(f) for f in FORMATS)}], CAST(p_partkey % {len(FORMATS)} AS INTEGER) + 1) AS f "
    "FROM part)"
)
def type_from_format_(spark, sf_dir):
    formats = F.array(*[F.lit(f).cast("string") for f in FORMATS])
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.get(formats, (F.col("p_partkey") % len(FORMATS)).cast("int")).alias("column_format")
    )
    return part.selectExpr("*", type_from_format("column_format", "'Double'") + " AS data_type")


QUERIES["type_from_format"] = QUERIES.pop("type_from_format_")
SQL["type_from_format"] = SQL.pop("type_from_format_")


@query(
    "SELECT 'orders_of_' || c_custkey AS logical_path, CAST(NULL AS VARCHAR) AS dataset_label, column_index, "
    "column_name, CAST(NULL AS VARCHAR) AS column_label, CAST(NULL AS VARCHAR) AS column_format, data_type "
    "FROM customer CROSS JOIN (VALUES "
    + ", ".join(f"({i}, '{c}', '{k}')" for i, (c, k) in enumerate(TABLE_COLUMNS["orders"]))
    + ") AS t(column_index, column_name, data_type)"
)
def type_from_physical(spark, sf_dir):
    infos = describe(table(spark, sf_dir, "orders"), [c for c, _ in TABLE_COLUMNS["orders"]])
    path = F.concat(F.lit("orders_of_"), F.col("c_custkey").cast("string"))
    return dictionary_of_datasets(table(spark, sf_dir, "customer").select(path.alias("logical_path")), infos)


CUSTOMER_PATH = f"'customer_' || (c_custkey // {X.ROWS_PER_FILE}) || '.xpt'"
CUSTOMER_DICTIONARY = [
    ("CUSTKEY", "Customer key", None, "Double"),
    ("NAME", "Customer name", None, "String"),
    ("NATION", None, "BEST9.3", "Double"),
    ("ACCTBAL", "Balance", "9.3", "Double"),
    ("SEGMENT", None, "$CHAR12.", "String"),
]
_ENTRIES = ", ".join(
    f"({i}, {', '.join(quoted(v) for v in entry)})" for i, entry in enumerate(CUSTOMER_DICTIONARY)
)
DICTIONARY_SQL = (
    f"SELECT logical_path, {quoted(X.CUSTOMER_LABEL)} AS dataset_label, column_index, column_name, column_label, "
    f"column_format, data_type FROM (SELECT DISTINCT {CUSTOMER_PATH} AS logical_path FROM customer) CROSS JOIN "
    f"(VALUES {_ENTRIES}) AS t(column_index, column_name, column_label, column_format, data_type)"
)


@query(DICTIONARY_SQL)
def column_dictionary(spark, sf_dir):
    return xpt.dictionary(X.customer_files(spark, sf_dir))


@query(
    "SELECT replace(path, '.xpt', '_' || copy || '.xpt') AS logical_path, 'Failed to read XPT file: ' || "
    f"['not a transport file', 'bad column count'][copy] AS error_msg FROM (SELECT DISTINCT {CUSTOMER_PATH} AS path "
    "FROM customer), range(1, 3) r(copy)"
)
def dictionary_errors(spark, sf_dir):
    """Of each customer file a good copy and two bad ones: the good one is not among the errors."""
    spoiled = X.customer_files(spark, sf_dir).selectExpr(
        "logical_path AS path",
        f"posexplode(array(content, X'00', overlay(content PLACING X'78787878' FROM {xpt.COUNT_AT + 1}))) AS (copy, content)",
    )
    return xpt.dictionary_errors(
        spoiled.selectExpr("replace(path, '.xpt', '_' || copy || '.xpt') AS logical_path", "content")
    )


@query(
    f"SELECT DISTINCT {CUSTOMER_PATH} AS logical_path, {quoted(X.CUSTOMER_LABEL)} AS dataset_label FROM customer"
)
def dataset_label(spark, sf_dir):
    files = xpt.dictionary(X.customer_files(spark, sf_dir))
    return files.filter(F.col("column_index") == 0).select("logical_path", "dataset_label")


_NAMES = (
    "SELECT p_brand AS logical_path, CAST(p_partkey AS INTEGER) AS column_index, "
    "CASE WHEN p_partkey % 3 = 0 THEN 'PART_' || p_partkey WHEN p_partkey % 2 = 0 THEN p_name "
    "ELSE p_type || '_' || p_brand || repeat('x', p_size // 2) END AS column_name FROM part"
)


def _named_columns(spark, sf_dir):
    long_name = F.concat_ws(
        "", "p_type", F.lit("_"), "p_brand", F.repeat(F.lit("x"), F.floor(F.col("p_size") / 2).cast("int"))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("logical_path"),
        F.col("p_partkey").cast("int").alias("column_index"),
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("PART_"), F.col("p_partkey").cast("string")))
        .when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(long_name).alias("column_name"),
    )


@query(f"SELECT * FROM ({_NAMES}) WHERE NOT regexp_full_match(column_name, '[a-zA-Z0-9_]+')")
def check_name_chars(spark, sf_dir):
    return quality.bad_name_characters(_named_columns(spark, sf_dir))


@query(f"SELECT * FROM ({_NAMES}) WHERE length(column_name) > 32")
def check_name_length(spark, sf_dir):
    return quality.bad_name_length(_named_columns(spark, sf_dir))


_FILE_NUMBER = "CAST(regexp_extract(logical_path, '_([0-9]+)', 1) AS BIGINT)"


_DICTIONARIES = (
    f"WITH a AS ({DICTIONARY_SQL}), e AS (SELECT logical_path, column_index, column_name, "
    f"CASE WHEN {_FILE_NUMBER} % 3 = 0 AND column_index = 3 THEN '12.2' ELSE column_format END AS column_format, "
    f"data_type FROM a WHERE NOT ({_FILE_NUMBER} % 2 = 0 AND column_index = 4) UNION ALL "
    f"SELECT DISTINCT logical_path, 9, 'EXTRA', NULL, 'Double' FROM a WHERE {_FILE_NUMBER} % 2 = 1) "
)
_DIFFERENCES = (
    "SELECT coalesce(a.logical_path, e.logical_path) AS logical_path, "
    "CAST(coalesce(a.column_index, e.column_index) AS INTEGER) AS column_index, "
    + ", ".join(
        f"{s}.{c} AS {t}_{c}"
        for s, t in (("a", "actual"), ("e", "expected"))
        for c in ("column_name", "column_format", "data_type")
    )
    + ", CASE WHEN a.logical_path IS NULL THEN 'missing' WHEN e.logical_path IS NULL THEN 'unexpected' "
    "ELSE 'different' END AS finding FROM a FULL JOIN e ON a.logical_path = e.logical_path "
    "AND a.column_index = e.column_index WHERE a.column_name IS DISTINCT FROM e.column_name "
    "OR a.column_format IS DISTINCT FROM e.column_format OR a.data_type IS DISTINCT FROM e.data_type"
)


def _dictionaries(spark, sf_dir):
    """The dictionaries of the files, and others that should be theirs."""
    actual = xpt.dictionary(X.customer_files(spark, sf_dir))
    paths = table(spark, sf_dir, "customer").select(
        X.part_path("customer", "c_custkey").alias("logical_path"),
        F.floor(F.col("c_custkey") / X.ROWS_PER_FILE).alias("number"),
    ).distinct()
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("column_index"), F.lit(n).alias("column_name"),
                     F.lit(f).cast("string").alias("column_format"), F.lit(t).alias("data_type"))
            for i, (n, _, f, t) in enumerate(CUSTOMER_DICTIONARY)
        ]
        + [F.struct(F.lit(9).alias("column_index"), F.lit("EXTRA").alias("column_name"),
                    F.lit(None).cast("string").alias("column_format"), F.lit("Double").alias("data_type"))]
    )
    index, number = F.col("column_index"), F.col("number")
    expected = (
        paths.select("logical_path", "number", F.inline(entries))
        .filter(~((number % 2 == 0) & (index == 4)) & ~((number % 2 == 0) & (index == 9)))
        .withColumn(
            "column_format", F.when((number % 3 == 0) & (index == 3), "12.2").otherwise(F.col("column_format"))
        )
    )
    return actual, expected


@query(_DICTIONARIES + _DIFFERENCES)
def check_dictionary(spark, sf_dir):
    return quality.dictionary_differences(*_dictionaries(spark, sf_dir))


def _signatures(of: str) -> str:
    texts = ", ".join(f"coalesce({c}, '')" for c in ("column_name", "column_format", "data_type"))
    return (f"SELECT logical_path, string_agg(concat_ws('|', column_index, {texts}), ';' ORDER BY column_index) AS s "
            f"FROM {of} GROUP BY logical_path")


@query(
    _DICTIONARIES + f", d AS ({_DIFFERENCES}), c AS (SELECT min(logical_path) AS first_path, count(*) AS files FROM "
    f"({_signatures('a')}) AS x FULL JOIN ({_signatures('e')}) AS y USING (logical_path) GROUP BY x.s, y.s) "
    "SELECT first_path, files, d.* EXCLUDE (logical_path) FROM d JOIN c ON logical_path = first_path"
)
def check_dictionary_classes(spark, sf_dir):
    """The same findings, once for all files that are alike."""
    return quality.dictionary_class_differences(*_dictionaries(spark, sf_dir))


@query(
    f"WITH a AS ({DICTIONARY_SQL}), f AS ({_signatures('a')}) SELECT min(logical_path) AS first_path, count(*) AS files, "
    "CAST(any_value(n) AS INTEGER) AS n_columns FROM f JOIN (SELECT logical_path, count(*) AS n FROM a GROUP BY 1) "
    "USING (logical_path) GROUP BY s"
)
def dictionary_classes(spark, sf_dir):
    """The different dictionaries of a table of files."""
    return quality.dictionary_classes(xpt.dictionary(X.customer_files(spark, sf_dir))).selectExpr(
        "first_path", "files", "size(columns) AS n_columns"
    )


# --- values -------------------------------------------------------------------


@query("SELECT doc_id, text AS value_string, CAST(n_chars AS VARCHAR) AS value_number FROM documents")
def value_string(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"{V.text('text')} AS value_string", f"{V.text('n_chars')} AS value_number"
    )


@query(
    "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value_double, "
    "TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS value_text, "
    "TRY_CAST(event_type AS DOUBLE) AS value_not_a_number FROM events"
)
def value_double(spark, sf_dir):
    nan = "CASE WHEN event_id % 5 = 0 THEN DOUBLE('NaN') ELSE value END"
    number = "regexp_extract(props, '[0-9]+', 0)"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"{V.double(nan)} AS value_double",
        f"{V.text_as_double(number)} AS value_text",
        f"{V.text_as_double('event_type')} AS value_not_a_number",
    )


@query(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN CASE WHEN o_orderkey % 4 = 0 "
    "THEN DATE '1960-01-01' - CAST(o_orderkey AS INTEGER) ELSE o_orderdate::DATE END END AS value_date FROM orders"
)
def value_date(spark, sf_dir):
    days = (
        "CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN -(o_orderkey + 0.75D) "
        "ELSE days + 0.5D END"
    )
    orders = table(spark, sf_dir, "orders").withColumn("days", X.order_days())
    return orders.selectExpr("o_orderkey", f"{V.days_to_date(days)} AS value_date")


_SIGNED = "CASE WHEN o_orderkey % 3 = 0 THEN -o_totalprice ELSE o_totalprice END"


@query(
    "SELECT o_orderkey, s AS value_time, "
    + TIME_TEXT.format(s="s")
    + f" AS value_string FROM (SELECT o_orderkey, CAST(trunc({_SIGNED}) AS INTEGER) AS s FROM orders)"
)
def value_time(spark, sf_dir):
    times = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{V.seconds_to_time(_SIGNED)} AS value_time")
    return times.selectExpr("*", f"{V.time_text('value_time')} AS value_string")


_EVENT_SECONDS = f"(unix_micros(CAST(ts AS TIMESTAMP)) / 1000000 + {V.EPOCH_SECONDS})"


@query("SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN ts END AS value_timestamp FROM events")
def value_timestamp(spark, sf_dir):
    seconds = f"CASE WHEN event_id % 6 <> 0 THEN {_EVENT_SECONDS} END"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{V.seconds_to_timestamp(seconds)} AS value_timestamp"
    )


_DAY_SECOND = "CAST(hour(t) * 3600 + minute(t) * 60 + second(t) AS INTEGER)"


@query(
    f"SELECT event_id, s AS value_time, {TIME_TEXT.format(s='s')} AS value_string FROM (SELECT event_id, "
    f"CASE WHEN event_id % 6 <> 0 THEN {_DAY_SECOND} END AS s FROM (SELECT event_id, "
    "CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 30000 DAY ELSE ts END AS t FROM events))"
)
def value_tod(spark, sf_dir):
    """Also before 1960 and 1970, where the seconds are negative."""
    shift = f"CASE WHEN event_id % 2 = 0 THEN {30000 * V.SECONDS_PER_DAY}L ELSE 0L END"
    seconds = f"CASE WHEN event_id % 6 <> 0 THEN {_EVENT_SECONDS} - {shift} END"
    times = table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{V.seconds_to_time_of_day(seconds)} AS value_time"
    )
    return times.selectExpr("*", f"{V.time_text('value_time')} AS value_string")


@query(
    cells_sql(
        f"SELECT event_id, ts, t, {_DAY_SECOND} AS s FROM (SELECT *, ts AS t FROM events)",
        "'events'",
        "event_id",
        [
            ("as_date", None, "DATE9.", "Date", {"value_date": "ts::DATE"}),
            ("as_time", None, "TIME8.", "Time", {"value_time": "s", "value_string": TIME_TEXT.format(s="s")}),
            ("as_tod", None, "TOD8.", "Time", {"value_time": "s", "value_string": TIME_TEXT.format(s="s")}),
            ("as_datetime", None, "DATETIME20.", "Timestamp", {"value_timestamp": "ts"}),
            ("day", None, "DATETIME.", "Timestamp", {"value_timestamp": "ts::DATE"}),
        ],
    )
)
def value_from_timestamp(spark, sf_dir):
    names = {"as_date": "DATE9.", "as_time": "TIME8.", "as_tod": "TOD8.", "as_datetime": "DATETIME20."}
    events = table(spark, sf_dir, "events").select(
        "event_id", *[F.col("ts").alias(n) for n in names], F.col("ts").cast("date").alias("day")
    )
    return cf.to_cells(
        events, "events", columns=[*names, "day"], order_by=["event_id"], formats=names | {"day": "DATETIME."},
        rows_per_bucket=ROWS_PER_BUCKET,
    )


_GONE = "CASE WHEN event_id % 4 <> 0 THEN {} END"


@query(
    cells_sql(
        "SELECT * FROM events",
        "'events'",
        "event_id",
        [
            ("number", None, None, "Double", {"value_double": _GONE.format("value")}),
            ("name", None, None, "String", {"value_string": _GONE.format("event_type")}),
            ("tod", None, "TOD8.", "Time", {}),
        ],
    )
)
def value_missing(spark, sf_dir):
    here = F.col("event_id") % 4 != 0
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(here, F.col("value")).otherwise(F.lit(float("nan"))).alias("number"),
        F.when(here, F.col("event_type")).alias("name"),
        F.lit(None).cast("double").alias("tod"),
    )
    return cf.to_cells(
        events, "events", columns=["number", "name", "tod"], order_by=["event_id"], formats={"tod": "TOD8."},
        rows_per_bucket=ROWS_PER_BUCKET,
    )


@query(
    "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN DATE '0001-01-01' WHEN 1 THEN DATE '9999-12-31' END "
    "AS value_date, CASE p_partkey % 4 WHEN 0 THEN TIMESTAMP '0001-01-01 00:00:00' "
    "WHEN 1 THEN TIMESTAMP '9999-12-31 00:00:00' END AS value_timestamp, "
    "CASE p_partkey % 4 WHEN 0 THEN -715509 WHEN 1 THEN 2936549 END AS value_time FROM part"
)
def value_out_of_range(spark, sf_dir):
    days = (
        f"CASE p_partkey % 4 WHEN 0 THEN {V.MIN_DAY}D WHEN 1 THEN {V.MAX_DAY}D "
        f"WHEN 2 THEN {V.MAX_DAY + 1}D + p_partkey * 1000 ELSE DOUBLE('NaN') END"
    )
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{days} AS days")
    seconds = "CASE WHEN p_partkey % 4 = 2 THEN days * 10000 ELSE days END"
    return part.selectExpr(
        "p_partkey",
        f"{V.days_to_date('days')} AS value_date",
        f"{V.seconds_to_timestamp(f'days * {V.SECONDS_PER_DAY}')} AS value_timestamp",
        f"{V.seconds_to_time(seconds)} AS value_time",
    )


# --- files --------------------------------------------------------------------

PAGES = (
    "SELECT 'page_' || page_id || list_extract(['.xpt', '.XPT', '.sas7bdat', '.txt', ''], "
    "CAST(page_id % 5 AS INTEGER) + 1) AS logical_path, encode(html) AS content FROM pages"
)
_FORMAT = (
    "CASE WHEN lower(logical_path) LIKE '%.xpt' THEN 'xpt' "
    "WHEN lower(logical_path) LIKE '%.sas7bdat' THEN 'sas7bdat' END"
)
_PAGE_ERROR = (
    f"CASE {_FORMAT} WHEN 'xpt' THEN 'Failed to read XPT file: not a transport file' "
    "WHEN 'sas7bdat' THEN 'Failed to parse SAS file: magic number mismatch (not a SAS file?)' "
    "ELSE 'Unsupported SAS dataset (only .sas7bdat and .xpt supported): ' || logical_path END"
)


@query(f"SELECT logical_path, CAST(octet_length(content) AS INTEGER) AS length FROM ({PAGES})")
def file_table(spark, sf_dir):
    """A table of contents as a collection of files."""
    return X.page_files(spark, sf_dir).select("logical_path", F.length("content").alias("length"))


_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
_TABLE_FILES = "SELECT unnest([" + ", ".join(f"'{t}.parquet'" for t in _TABLES) + "]) AS name"
_BASE_NAME = "substring_index(logical_path, '/', -1)"


@query(f"SELECT name, true AS whole, 'PAR1' AS magic FROM ({_TABLE_FILES})")
def scan_files(spark, sf_dir):
    """The files of the tables themselves, with their contents, in ranges: a table may be larger than a row can be."""
    contents = files.scan_files(spark, sf_dir, ".parquet", range_bytes=files.RANGE_BYTES)
    # Dealt out before they are put together, so that only these values are, and no buffer of a sort holds contents.
    ranges = contents.selectExpr(
        "logical_path", "length", "length(content) AS size",
        "CASE WHEN offset = 0 THEN CAST(substr(content, 1, 4) AS STRING) END AS magic",
    ).repartition("logical_path")
    found = ranges.groupBy("logical_path", "length").agg(
        F.expr("bool_and(size IS NOT NULL) AS is_read"), F.sum("size").alias("size"), F.max("magic").alias("magic")
    )
    return found.selectExpr(
        f"{_BASE_NAME} AS name", "CASE WHEN is_read THEN size = length END AS whole",
        "CASE WHEN is_read THEN magic END AS magic",
    )


@query(
    "SELECT name, 'Unsupported SAS dataset (only .sas7bdat and .xpt supported): ' || name AS error "
    f"FROM ({_TABLE_FILES})"
)
def read_folder(spark, sf_dir):
    """A folder as a dataset collection: every file that is none becomes an error row with its path."""
    cells = cf.read_files(spark, sf_dir)
    return cells.selectExpr(f"{_BASE_NAME} AS name", f"replace(error_msg, logical_path, {_BASE_NAME}) AS error").where(
        "name LIKE '%.parquet'"
    )


@query(f"SELECT logical_path, {_FORMAT} IS NOT NULL AS supported FROM ({PAGES})")
def route_supported(spark, sf_dir):
    files = X.page_files(spark, sf_dir)
    return files.select("logical_path", routing.is_supported(F.col("logical_path")).alias("supported"))


@query(f"SELECT logical_path, {_FORMAT} AS file_format FROM ({PAGES})")
def route_format(spark, sf_dir):
    return routing.route(X.page_files(spark, sf_dir)).select("logical_path", "file_format")


@query("SELECT " + sql_row("logical_path", _PAGE_ERROR) + f" FROM ({PAGES}) WHERE {_FORMAT} IS NULL")
def err_unsupported(spark, sf_dir):
    return routing.unsupported_files(X.page_files(spark, sf_dir))


@query("SELECT " + sql_row("logical_path", _PAGE_ERROR) + f" FROM ({PAGES}) WHERE {_FORMAT} = 'sas7bdat'")
def sas7bdat_bad_bytes(spark, sf_dir):
    return cf.parse_files(routing.of_format(X.page_files(spark, sf_dir), routing.SAS7BDAT))


@query("SELECT " + sql_row("logical_path", _PAGE_ERROR) + f" FROM ({PAGES}) WHERE {_FORMAT} = 'xpt'")
def err_bad_header(spark, sf_dir):
    return cf.parse_files(routing.of_format(X.page_files(spark, sf_dir), routing.XPT))


# What each spoiled copy of a customer file says, and the bytes put into it at which place (from 1).
_SPOILED = [
    ("not a transport file", 1, "00"),
    ("no member header", xpt.MEMBER_AT + 1, "00"),
    ("no column descriptors", xpt.COLUMNS_AT - xpt.CARD + 1, "00"),
    ("bad column count", xpt.COUNT_AT + 1, "78787878"),
    ("bad column descriptors", xpt.COLUMNS_AT + 5, "0000"),
    ("no observation header", X.CUSTOMER_HEADER - xpt.CARD + 1, "00"),
    ("A single table in XPT-file is supported, found 0: ", None, f"substr(content, 1, {xpt.MEMBER_AT})"),
    ("no content", None, "CAST(NULL AS BINARY)"),
]
_SPOILED_PATH = "replace(path, '.xpt', '_' || copy || '.xpt')"


@query(
    "SELECT " + sql_row(
        _SPOILED_PATH, "'Failed to read XPT file: ' || [" + ", ".join(quoted(m) for m, *_ in _SPOILED) + "][copy + 1]"
    ) + f" FROM (SELECT DISTINCT {CUSTOMER_PATH} AS path FROM customer), range({len(_SPOILED)}) r(copy)"
)
def err_every_header(spark, sf_dir):
    """Customer files, each spoiled in every way a header can be."""
    contents = [
        put if at is None else f"overlay(content PLACING X'{put}' FROM {at})" for _, at, put in _SPOILED
    ]
    spoiled = X.customer_files(spark, sf_dir).selectExpr(
        "logical_path AS path", f"posexplode(array({', '.join(contents)})) AS (copy, content)"
    )
    return cf.parse_files(spoiled.selectExpr(f"{_SPOILED_PATH} AS logical_path", "content"))


CUSTOMER_VALUES = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def customer_cells_sql(where: str = "true") -> str:
    columns = [
        (n, lab, fmt, t, {"value_string" if t == "String" else "value_double": v})
        for (n, lab, fmt, t), v in zip(CUSTOMER_DICTIONARY, CUSTOMER_VALUES)
    ]
    return cells_sql(
        f"SELECT *, {CUSTOMER_PATH} AS path FROM customer", "path", "c_custkey", columns, X.CUSTOMER_LABEL,
        where, "path",
    )


@query(customer_cells_sql())
def xpt_scan(spark, sf_dir):
    return cf.parse_files(X.customer_files(spark, sf_dir))


_KEYED = "CASE WHEN o_orderkey % {} <> 0 THEN {} END"
_OTIME = _KEYED.format(7, "CASE WHEN o_orderkey % 5 = 0 THEN -1 ELSE 1 END * (o_orderkey % 200000)")
_OTOD = _KEYED.format(13, "o_orderkey % 86400")


def order_cells_sql(extension: str = ".xpt", label: str | None = "Orders", fields: list[Field] | None = None) -> str:
    rows = (
        f"SELECT *, 'orders_' || (o_orderkey // {X.ROWS_PER_FILE}) || '{extension}' AS path, "
        f"{_OTIME} AS otime, {_OTOD} AS otod FROM orders"
    )
    columns = [
        ("ORDERKEY", None, None, "Double", {"value_double": "o_orderkey"}),
        ("ODATE", None, "DATE9.", "Date", {"value_date": _KEYED.format(11, "o_orderdate::DATE")}),
        ("OYMD", None, "YYMMDD10.", "Date", {"value_date": "o_orderdate::DATE"}),
        ("ODT", None, "DATETIME.", "Timestamp", {
            "value_timestamp": "o_orderdate + to_seconds(o_orderkey % 86400) + INTERVAL 250 MILLISECOND"}),
        ("OTIME", None, "TIME8.", "Time", {"value_time": "otime", "value_string": TIME_TEXT.format(s="otime")}),
        ("OTOD", None, "TOD8.", "Time", {"value_time": "otod", "value_string": TIME_TEXT.format(s="otod")}),
        ("PRICE", None, "best.", "Double", {
            "value_double": "CASE WHEN o_orderkey % 3 = 0 THEN -o_totalprice ELSE o_totalprice END"}),
        ("STATUS", None, None, "String", {"value_string": "o_orderstatus"}),
    ]
    for i, f in enumerate(fields or []):
        fmt = f"{f.format}{f.width or ''}." if f.format else None
        columns[i] = (f.name, f.label or None, fmt, *columns[i][3:])
    return cells_sql(rows, "path", "o_orderkey", columns, label, datasets="path")


@query(order_cells_sql())
def xpt_scan_typed(spark, sf_dir):
    return cf.parse_files(X.order_files(spark, sf_dir))


@query(order_cells_sql(fields=X.long_order_fields()))
def xpt_scan_v8(spark, sf_dir):
    """The extended layout, with names, labels and formats that the older one cannot hold."""
    return cf.parse_files(X.long_order_files(spark, sf_dir))


_NAME = f"translate(c_name, {quoted(X.STRANGE_LETTERS[0])}, {quoted(X.STRANGE_LETTERS[1])})"


@query(
    cells_sql(
        f"SELECT *, {CUSTOMER_PATH} AS path FROM customer",
        "path",
        "c_custkey",
        [
            ("CUSTKEY", None, None, "Double", {"value_double": "c_custkey"}),
            ("NAME", None, None, "String", {"value_string": f"CASE WHEN c_custkey % 7 <> 0 THEN {_NAME} END"}),
        ],
        label="Größe in €",
        datasets="path",
        errors={1: "CASE WHEN c_custkey % 7 = 0 THEN 'Failed to get value: the bytes are not windows-1252 text' END"},
    )
)
def xpt_scan_windows1252(spark, sf_dir):
    return cf.parse_files(X.windows_files(spark, sf_dir), encoding="windows-1252")


_COPIES = f"SELECT copy, path, n FROM (SELECT {CUSTOMER_PATH} AS path, count(*) AS n FROM customer GROUP BY 1), range(4) r(copy)"
_NO_FILE = "'Failed to read XPT file: not a transport file'"
_CUT = "'Failed to get next row: the file ends inside a record'"
_ENDS_CUT = f"copy = 1 AND n > {X.ROWS_PER_FILE // 2}"


def _without_folder(df: DataFrame) -> DataFrame:
    """Paths from the last folder on, as that above is new in every run."""
    return df.withColumn("logical_path", F.substring_index("logical_path", "/", -2))


@query(
    f"SELECT copy || '/' || path AS logical_path, {quoted(X.CUSTOMER_LABEL)} AS dataset_label, column_index, column_name, "
    f"column_label, column_format, data_type, CAST(NULL AS VARCHAR) AS error_msg FROM ({_COPIES}) CROSS JOIN "
    f"(VALUES {_ENTRIES}) AS t(column_index, column_name, column_label, column_format, data_type) WHERE copy < 3 "
    f"UNION ALL SELECT '3/' || path, NULL, NULL, NULL, NULL, NULL, NULL, {_NO_FILE} FROM ({_COPIES}) WHERE copy = 3"
)
def read_dictionary(spark, sf_dir):
    """Dictionaries of a folder of files, by their headers alone."""
    folder = X.written_folder(X.spoiled_customer_files(spark, sf_dir, X.ROWS_PER_FILE // 2))
    return _without_folder(xpt.read_dictionary(spark, folder))


@query(
    f"SELECT copy || '/' || path AS logical_path, CAST(rows AS BIGINT) AS n_rows, columns AS n_columns, "
    f"CAST(rows * columns AS BIGINT) AS cells, CASE WHEN copy = 3 THEN {_NO_FILE} WHEN copy = 2 THEN 'Empty SAS dataset' "
    f"WHEN {_ENDS_CUT} THEN {_CUT} END AS error_msg FROM (SELECT *, CAST(CASE copy WHEN 3 THEN 0 ELSE 5 END AS INTEGER) "
    f"AS columns, CASE copy WHEN 0 THEN n WHEN 1 THEN least(n, {X.ROWS_PER_FILE // 2}) ELSE 0 END AS rows FROM ({_COPIES}))"
)
def cell_count_of_files(spark, sf_dir):
    """Rows and cells of a folder of files, by headers and lengths alone."""
    folder = X.written_folder(X.spoiled_customer_files(spark, sf_dir, X.ROWS_PER_FILE // 2))
    return _without_folder(xpt.read_counts(spark, folder))


def _copy_cells(copy: int, where: str) -> str:
    cells = customer_cells_sql(where).replace(f"{CUSTOMER_PATH} AS path", f"'{copy}/' || {CUSTOMER_PATH} AS path")
    return f"SELECT * FROM ({cells})"


_FOLDER_CELLS = (
    _copy_cells(0, "true") + " UNION ALL " + _copy_cells(1, f"rn <= {X.ROWS_PER_FILE // 2}") + " UNION ALL SELECT " + sql_row(
        "copy || '/' || path", f"CASE WHEN copy = 3 THEN {_NO_FILE} WHEN copy = 2 THEN 'Empty SAS dataset' ELSE {_CUT} END"
    ) + f" FROM ({_COPIES}) WHERE copy > 1 OR {_ENDS_CUT}"
)


@query(_FOLDER_CELLS)
def read_files_whole(spark, sf_dir):
    """Cells of a folder of files, each read whole."""
    return _without_folder(cf.read_files(
        spark, X.written_folder(X.spoiled_customer_files(spark, sf_dir, X.ROWS_PER_FILE // 2))))


@query(f"SELECT * FROM ({_FOLDER_CELLS}) ORDER BY logical_path, row_index NULLS FIRST, column_index NULLS FIRST LIMIT 10000")
def sample_cells_of_files(spark, sf_dir):
    """The first cells of the folder; of the files, only the ranges of bytes that hold these are read."""
    folder = X.written_folder(X.spoiled_customer_files(spark, sf_dir, X.ROWS_PER_FILE // 2))
    return _without_folder(xpt.read_first(spark, folder, 10_000))


@query(_FOLDER_CELLS)
def read_files_by_ranges(spark, sf_dir):
    """The same files, each read by ranges of bytes."""
    return _without_folder(cf.read_files(
        spark, X.written_folder(X.spoiled_customer_files(spark, sf_dir, X.ROWS_PER_FILE // 2)), whole_file_bytes=-1))


@query(order_cells_sql(".sas7bdat", label=None))
def sas7bdat_scan(spark, sf_dir):
    return cf.parse_files(sas7bdat_files(X.order_rows(spark, sf_dir), X.part_path("orders", "ORDERKEY", ".sas7bdat"),
                                         ["ORDERKEY"], X.ORDER_FIELDS))


def _mixed_files(spark, sf_dir):
    return X.customer_files(spark, sf_dir).unionByName(X.page_files(spark, sf_dir))


@query(
    f"SELECT {CUSTOMER_PATH} AS logical_path, count(*) * {len(CUSTOMER_VALUES)} AS cells, 0 AS errors FROM customer "
    f"GROUP BY 1 UNION ALL SELECT logical_path, 0, 1 FROM ({PAGES})"
)
def err_isolation(spark, sf_dir):
    bad = F.col("error_msg").isNotNull()
    return cf.parse_files(_mixed_files(spark, sf_dir)).groupBy("logical_path").agg(
        F.count_if(~bad).alias("cells"), F.count_if(bad).cast("int").alias("errors")
    )


@query(customer_cells_sql())
def split_data(spark, sf_dir):
    return cf.data_rows(cf.parse_files(_mixed_files(spark, sf_dir)))


@query("SELECT " + sql_row("logical_path", _PAGE_ERROR) + f" FROM ({PAGES})")
def split_errors(spark, sf_dir):
    return cf.error_rows(cf.parse_files(_mixed_files(spark, sf_dir)))


@query(
    "SELECT " + sql_row(
        "path",
        "'Failed to read XPT file: A single table in XPT-file is supported, found 3: CUST, ZED, ABE'",
    ) + f" FROM (SELECT DISTINCT {CUSTOMER_PATH} AS path FROM customer)"
)
def err_multi_table(spark, sf_dir):
    """Two more members, not in the order of their names."""

    def member(name: str) -> str:
        at = xpt.MEMBER_NAME_AT - xpt.MEMBER_AT + 1
        return f"overlay(substr(content, {xpt.MEMBER_AT + 1}) PLACING X'{name.ljust(8).encode().hex()}' FROM {at})"

    more = F.expr(f"concat(content, {member('ZED')}, {member('ABE')})")
    return cf.parse_files(X.customer_files(spark, sf_dir).withColumn("content", more))


@query(
    cells_sql(
        f"SELECT *, {CUSTOMER_PATH} AS path FROM customer", "path", "c_custkey",
        [(n, lab, fmt, None if i == 1 else t, {} if i == 1 else {"value_string" if t == "String" else "value_double": v})
         for i, ((n, lab, fmt, t), v) in enumerate(zip(CUSTOMER_DICTIONARY, CUSTOMER_VALUES))],
        label=X.CUSTOMER_LABEL, datasets="path", errors={1: "'Unsupported data type 7'"},
    )
)
def err_unsupported_kind(spark, sf_dir):
    """A column that is neither number nor text: errors in its cells, the other columns intact."""
    kind_at = xpt.COLUMNS_AT + 140 + 1
    spoiled = F.expr(f"overlay(content PLACING X'0007' FROM {kind_at})")
    return cf.parse_files(X.customer_files(spark, sf_dir).withColumn("content", spoiled))


KEPT = X.ROWS_PER_FILE // 2


@query(
    customer_cells_sql(f"rn <= {KEPT}")
    + " UNION ALL SELECT "
    + sql_row("path", "'Failed to get next row: the file ends inside a record'")
    + f" FROM (SELECT {CUSTOMER_PATH} AS path FROM customer GROUP BY 1 HAVING count(*) > {KEPT})"
)
def err_truncated(spark, sf_dir):
    """Files cut off inside a record: the rows before the cut, then one error row."""
    size = X.CUSTOMER_HEADER + KEPT * X.CUSTOMER_RECORD + 5
    cut = F.col("content").substr(1, size)
    return cf.parse_files(X.customer_files(spark, sf_dir).withColumn("content", cut))


_BAD = "c_custkey % 7 = 0"


@query(
    cells_sql(
        f"SELECT *, {CUSTOMER_PATH} AS path FROM customer",
        "path",
        "c_custkey",
        [
            ("CUSTKEY", None, None, "Double", {"value_double": "c_custkey"}),
            ("NAME", None, None, "String", {"value_string": f"CASE WHEN NOT ({_BAD}) THEN c_name END"}),
        ],
        datasets="path",
        errors={1: f"CASE WHEN {_BAD} THEN 'Failed to get value: the bytes are not UTF-8 text' END"},
    )
)
def err_bad_cell(spark, sf_dir):
    """Bytes that are no text in one cell spoil that cell only."""
    name = F.encode("c_name", "UTF-8")
    spoiled = F.when(F.col("c_custkey") % 7 == 0, F.concat(name, F.lit(b"\xff"))).otherwise(name)
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CUSTKEY"), spoiled.alias("NAME"))
    files = transport_files(
        rows, X.part_path("customer", "CUSTKEY"), ["CUSTKEY"], [Field("CUSTKEY"), Field("NAME", 20, True)]
    )
    return cf.parse_files(files)
