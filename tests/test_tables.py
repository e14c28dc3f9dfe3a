"""Tables to cells: types, numbering, and the shape of the plans."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import Window, functions as F

import __spark_entry__ as entry_point
import cellframe as cf
from cellframe.functions import values as V
from cellframe.functions.formats import format_text, type_from_format, type_of_format
from cellframe.operators import quality, row_index
from cellframe.operators.cells import pivot
from cellframe.operators.dictionary import describe
from cellframe.operators.row_index import with_row_index
from cellframe.sources.xpt import typed_cells

ALL_TYPES = """
    SELECT 1 AS id, 'text' AS s, true AS b, 7Y AS tiny, 2.50BD AS dec, FLOAT(0.5) AS f, DATE'2020-01-01' AS d,
           TIMESTAMP'2020-01-01 01:02:03.5' AS ts, TIMESTAMP_NTZ'2020-01-01 01:02:03' AS ntz,
           array(1) AS arr, map('k', 1) AS m, named_struct('x', 1) AS st, X'00' AS bin, 93784.9 AS secs, -1 AS neg
"""


def by_column(cells):
    return {r.column_name: r for r in cells.collect()}


def test_every_type(spark):
    formats = {"secs": "TIME8.", "neg": "hhmm5.", "s": "DATE9."}
    cells = cf.to_cells(spark.sql(ALL_TYPES), "t", order_by=["id"], formats=formats, dataset_label="it's")
    assert cf.matches_contract(cells)
    got = by_column(cells)
    assert len(got) == 15
    assert {n: r.data_type for n, r in got.items()} == {
        "id": "Double", "s": "String", "b": "String", "tiny": "Double", "dec": "Double", "f": "Double", "d": "Date",
        "ts": "Timestamp", "ntz": "Timestamp", "arr": None, "m": None, "st": None, "bin": None, "secs": "Time",
        "neg": "Time",
    }
    assert (got["s"].value_string, got["b"].value_string) == ("text", "true")
    assert [got[n].value_double for n in ("id", "tiny", "dec", "f")] == [1.0, 7.0, 2.5, 0.5]
    assert got["d"].value_date == date(2020, 1, 1)
    assert got["ts"].value_timestamp == datetime(2020, 1, 1, 1, 2, 3, 500000)
    assert got["ntz"].value_timestamp == datetime(2020, 1, 1, 1, 2, 3)
    assert (got["secs"].value_time, got["secs"].value_string) == (93784, "26:03:04")
    assert (got["neg"].value_time, got["neg"].value_string) == (-1, "-00:00:01")
    assert got["arr"].error_msg == "Unsupported data type array<int>"
    assert got["m"].error_msg == "Unsupported data type map<string,int>"
    assert {r.dataset_label for r in got.values()} == {"it's"}
    slots = [[r[s] for s in V_SLOTS if r[s] is not None] for r in got.values()]
    assert [len(s) for s in slots] == [1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 2, 2]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_values_do_not_depend_on_the_session_zone(spark, zone):
    """Local times and dates are meant as UTC; 2021-03-14 02:30 does not exist in New York."""
    sql = (
        "SELECT 1 AS id, TIMESTAMP_NTZ'2021-03-14 02:30:03.25' AS local, TIMESTAMP'2020-01-01 01:02:03Z' AS instant, "
        "TIMESTAMP_NTZ'1890-05-06 23:59:59.999999' AS old, DATE'2020-01-01' AS day"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(sql)
        for format, slot in (("DATE9.", "value_date"), ("TOD8.", "value_time"), ("DATETIME20.", "value_timestamp")):
            names = ["local", "instant", "old", "day"]
            cells = cf.to_cells(df, "t", columns=names, order_by=["id"], formats=dict.fromkeys(names, format))
            as_text = f"unix_micros({slot})" if slot == "value_timestamp" else f"CAST({slot} AS STRING)"
            got = {r.column_name: r.v for r in cells.selectExpr("column_name", f"{as_text} AS v").collect()}
            assert got == {
                "value_date": {"local": "2021-03-14", "instant": "2020-01-01", "old": "1890-05-06", "day": "2020-01-01"},
                "value_time": {"local": "9003", "instant": "3723", "old": "86399", "day": "0"},
                "value_timestamp": {"local": 1615689003250000, "instant": 1577840523000000,
                                    "old": -2513635200000001, "day": 1577836800000000},
            }[slot]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


V_SLOTS = ["value_string", "value_double", "value_date", "value_time", "value_timestamp"]


def test_metadata_of_fields_and_odd_names(spark):
    df = spark.range(2).select(
        F.col("id").alias("a`b.c", metadata={"label": "Day's", "format": "DATE9."}), F.col("id").alias("n")
    )
    cells = cf.to_cells(df, "t", row_index="n").orderBy("row_index").collect()
    assert [(c.column_name, c.column_label, c.column_format, c.value_date) for c in cells] == [
        ("a`b.c", "Day's", "DATE9.", date(1960, 1, 1)), ("a`b.c", "Day's", "DATE9.", date(1960, 1, 2)),
    ]
    assert [i.label for i in describe(df)] == ["Day's", None]


def test_arguments(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="either"):
        cf.to_cells(df, "t")
    with pytest.raises(ValueError, match="no columns"):
        cf.to_cells(df, "t", row_index="id")


def test_empty_table_is_one_error_row(spark):
    df = spark.range(3)
    assert cf.parse_table(df, "t", order_by=["id"]).count() == 3
    (row,) = cf.parse_table(df.filter("id > 5"), "t", order_by=["id"]).collect()
    assert (row.logical_path, row.error_msg, row.row_index) == ("t", "Empty SAS dataset", None)


def test_wide_tables(spark):
    df = spark.range(20).select(
        "id", *[(F.col("id") * i).alias(f"d{i}") if i % 2 else F.concat(F.lit("s"), "id").alias(f"s{i}") for i in range(300)]
    )
    cells = cf.to_cells(df, "t", columns=df.columns[1:], row_index="id")
    assert cells.count() == 6000
    assert cells.filter("column_index = 7 AND row_index = 3").first().value_double == 21.0


def test_pivot_back_gives_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    cells = cf.to_cells(df, "c", order_by=["c_custkey"])
    back = cells.groupBy("row_index").pivot("column_name", df.columns).agg(
        F.first("value_string").alias("s"), F.first("value_double").alias("d")
    )
    again = back.select(
        F.col("c_custkey_d").cast("long").alias("c_custkey"), F.col("c_name_s").alias("c_name"),
        F.col("c_nationkey_d").cast("int").alias("c_nationkey"), F.col("c_acctbal_d").alias("c_acctbal"),
        F.col("c_mktsegment_s").alias("c_mktsegment"),
    )
    assert again.count() == df.count() and again.exceptAll(df).count() == 0


def test_row_index_with_hot_datasets_and_nulls(spark):
    """One dataset has two thirds of the rows; keys have nulls and repeats."""
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 < 2, "hot")
        .when(F.col("id") % 50 != 7, F.concat(F.lit("d"), F.col("id") % 50))
        .alias("set"),
        F.when(F.col("id") % 17 != 0, F.concat(F.lit("k"), F.hash("id") % 10)).alias("k"),
        F.when(F.col("id") % 5 != 0, F.rand(3)).alias("r"),
        "id",
    )
    got = with_row_index(df, ["k", "r", "id"], ["set"], rows_per_bucket=500)
    window = Window.partitionBy("set").orderBy(*[F.col(c).asc_nulls_first() for c in ("k", "r", "id")])
    wanted = df.withColumn("row_index", (F.row_number().over(window) - 1).cast("int"))
    assert got.columns == wanted.columns
    assert got.count() == 20000 and got.exceptAll(wanted).count() == 0


@pytest.mark.parametrize("keys", [["k"], ["k", "r"]])
def test_row_index_by_a_part_of_the_order(spark, keys):
    df = spark.range(6000).select(
        F.when(F.col("id") % 17 != 0, F.col("id") % 900).alias("k"), F.rand(3).alias("r"), "id"
    )
    got = with_row_index(df, ["k", "r", "id"], rows_per_bucket=300, bucket_by=keys)
    window = Window.orderBy(*[F.col(c).asc_nulls_first() for c in ("k", "r", "id")])
    wanted = df.withColumn("row_index", (F.row_number().over(window) - 1).cast("int"))
    assert got.count() == 6000 and got.exceptAll(wanted).count() == 0
    with pytest.raises(ValueError, match="bucket_by"):
        with_row_index(df, ["k", "id"], bucket_by=["id"])


@pytest.mark.parametrize("dataset_by", [[], ["set"]])
def test_a_heavy_value_is_cut_by_the_rest_of_the_order(spark, dataset_by):
    """Nine tenths of the rows have one value; it is an instant with microseconds, others are null."""
    heavy = F.expr("TIMESTAMP'2020-01-01 01:02:03.123456'")
    df = spark.range(40000).select(
        F.when(F.col("id") % 10 != 0, heavy)
        .when(F.col("id") % 20 == 0, heavy + F.expr("make_dt_interval(0, 0, 0, CAST(id - 20000 AS DECIMAL(18, 6)))")).alias("k"),
        F.when(F.col("id") % 7 != 0, F.rand(3)).alias("r"), "id", F.when(F.col("id") % 4 > 0, "a").alias("set"),
    )
    order = ["k", "r", "id"]
    got = with_row_index(df, order, dataset_by, rows_per_bucket=1000, bucket_by=["k"])
    window = Window.partitionBy(*dataset_by).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    wanted = df.withColumn("row_index", (F.row_number().over(window) - 1).cast("int"))
    assert got.count() == 40000 and got.exceptAll(wanted).count() == 0
    bucket = row_index._bucket(df, order, dataset_by, ["k"], 40000, 41)
    sizes = [r["count"] for r in df.groupBy(bucket.alias("b"), *dataset_by).count().collect()]
    assert len(sizes) > 30 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


@pytest.mark.parametrize("heavy", [False, True])
def test_the_search_of_a_bucket_never_walks_over_all_boundaries(spark, heavy):
    """A row's work may grow with the logarithm of the number of boundaries alone: these are folded, and only indexed."""
    df = spark.range(20000).select((F.when(F.col("id") % 10 != 0, 0) if heavy else F.col("id")).alias("k"), "id")
    bucket = row_index._bucket(df, ["k", "id"], [], ["k"], 20000, 200)
    plan = df.select(bucket.alias("b"))._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "sort_array" not in plan
    assert "transform([[" not in plan  # the literal of boundaries inside a higher-order function
    assert df.select(bucket.alias("b")).distinct().count() > 100


def test_without_heavy_values_only_the_leading_columns_are_read(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    key = row_index._bucket(df, df.columns, [], ["l_orderkey"], 6000, 10)
    plan = df.groupBy(key.alias("b")).count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan


def test_filters_over_cells_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumn("logical_path", F.col("o_orderpriority"))
    path = F.concat(F.lit("p/"), "o_orderpriority")
    for columns, datasets in [
        ("column_index IN (1, 3)", "logical_path LIKE '%LOW'"), ("data_type = 'String'", "logical_path = 'p/1-URGENT'"),
        ("column_format IS NULL AND column_name = 'o_orderdate'", "logical_path = 'none'"), ("false", "true"),
        ("column_label = 'x'", "true"),
    ]:
        options = {"order_by": ["o_orderkey"], "labels": {"o_custkey": "x"}, "rows_per_bucket": 200}
        got = cf.to_cells(df, path, columns_where=columns, datasets_where=datasets, **options)
        wanted = cf.to_cells(df, path, **options).where(columns).where(datasets)
        assert cf.matches_contract(got)
        assert got.count() == wanted.count() and got.exceptAll(wanted).count() == 0
    plan = entry_point.queries()["cells_filtered"](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    read = {c.partition(":")[0] for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) for c in s.split(",") if c}
    assert read == {"o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice"}
    empty = cf.parse_table(df.limit(0), "t", order_by=["o_orderkey"], columns_where="column_name IS NULL")
    assert [r.error_msg for r in empty.collect()] == ["Empty SAS dataset"]
    assert cf.parse_table(df.limit(0), "t", order_by=["o_orderkey"], columns_where="column_name = 'o_orderkey'").isEmpty()


def test_rows_past_32_bits_keep_their_cells(spark):
    index = F.col("id") + 2**31 - 2
    rows = spark.range(4).select(row_index._to_int(index).alias("n"), F.lit("v").alias("t"))
    cells = pivot(rows.withColumn("_path", F.lit("p")), describe(rows, ["t"]), "_path", "n", unnumbered="too many")
    got = sorted(((r.row_index, r.value_string, r.error_msg) for r in cells.collect()), key=str)
    assert got == [(2147483646, "v", None), (2147483647, "v", None), (None, "v", "too many"), (None, "v", "too many")]
    raw = spark.sql(
        "SELECT 'p' AS logical_path, CAST(NULL AS STRING) AS dataset_label, CAST(NULL AS STRING) AS error, id AS row, "
        "named_struct('index', 0, 'name', 'n', 'label', '', 'format', '', 'type', 'Double', 'time_of_day', false) AS c, "
        "CAST(NULL AS STRING) AS text, 1.5D AS number FROM range(2147483647, 2147483649)"
    )
    got = [(r.row_index, r.value_double, r.error_msg) for r in typed_cells(raw).orderBy("row_index").collect()]
    assert got == [(None, 1.5, "Failed to get next row: more rows than row_index can number"), (2147483647, 1.5, None)]


def test_the_registered_query_prunes(spark):
    plan = entry_point.queries()["cells_pruned"](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan.executedPlan().toString())
    assert schemas and all(
        {c.partition(":")[0] for c in s.split(",") if c} <= {"o_orderkey", "o_orderdate", "o_orderstatus"} for s in schemas
    )


def test_row_index_moves_rows_once(spark):
    """Also where the bucket counts are too many to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = spark.range(10000).select("id", F.rand(1).alias("v"), (F.col("id") % 3).alias("set"))
        indexed = with_row_index(df, ["v", "id"], ["set"], rows_per_bucket=100)
        plan = indexed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # the rows by group; the counts by group, by dataset, and by group again
    assert plan.count("Exchange hashpartitioning") == 4 and "Python" not in plan


def test_pruning_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cells = cf.to_cells(df, "l", columns=["l_tax"], row_index="l_orderkey")
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan
    assert "Exchange" not in plan and "Python" not in plan


VALUES = [
    (0.0, date(1960, 1, 1), 0, "00:00:00", datetime(1960, 1, 1), 0),
    (-1.0, date(1959, 12, 31), -1, "-00:00:01", datetime(1959, 12, 31, 23, 59, 59), 86399),
    (21915.9, date(2020, 1, 1), 21915, "06:05:15", datetime(1960, 1, 1, 6, 5, 15, 900000), 21915),
    (86399.0, date(2196, 7, 20), 86399, "23:59:59", datetime(1960, 1, 1, 23, 59, 59), 86399),
    (93784.0, date(2216, 10, 9), 93784, "26:03:04", datetime(1960, 1, 2, 2, 3, 4), 7384),
    (-715509.0, date(1, 1, 1), -715509, "-198:45:09", datetime(1959, 12, 23, 17, 14, 51), 62091),
    (2936549.0, date(9999, 12, 31), 2936549, "815:42:29", datetime(1960, 2, 3, 23, 42, 29), 85349),
    (2936550.0, None, 2936550, "815:42:30", datetime(1960, 2, 3, 23, 42, 30), 85350),
    (1e15, None, None, None, None, None),
    (-1e300, None, None, None, None, None),
    (float("nan"), None, None, None, None, None),
    (float("inf"), None, None, None, None, None),
    (None, None, None, None, None, None),
]


def test_values(spark):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(VALUES)], "i int, v double")
    got = df.selectExpr(
        "i", V.days_to_date("v"), V.seconds_to_time("v"), V.time_text(V.seconds_to_time("v")),
        V.seconds_to_timestamp("v"), V.seconds_to_time_of_day("v"),
    )
    assert [tuple(r)[1:] for r in got.orderBy("i").collect()] == [v[1:] for v in VALUES]
    extreme = spark.range(1).selectExpr(V.time_text("CAST(-2147483648 AS INT)")).first()[0]
    assert extreme == "-596523:14:08"


def test_formats(spark):
    wanted = {
        "DATE9.": "Date", "date.": "Date", "DATETIME20.": "Timestamp", "DTDATE9.": "Timestamp", "TOD8.": "Time",
        "YYMMDD10.": "Date", "HHMM5.": "Time", "TIMEAMPM.": "Time", "BEST9.3": None, "$DATE.": None, "": None,
    }
    assert {f: type_of_format(f) for f in wanted} == wanted
    df = spark.createDataFrame([(f,) for f in wanted], "f string")
    assert dict(df.selectExpr("f", type_from_format("f", "NULL")).collect()) == wanted
    more = (("DATE", "Date"), ("MON'Y", "Date"))
    assert spark.sql(f"SELECT {type_from_format(chr(34) + 'mon' + chr(39) + 'y5' + chr(34), 'NULL', more)}").first()[0] == "Date"
    written = spark.sql(
        "SELECT " + ", ".join(format_text(f"'{n}'", str(w), str(d)) for n, w, d in
                              (("DATE", 9, 0), ("BEST", 9, 3), ("", 9, 3), ("DATE", 0, 0), ("", 0, 0)))
    ).first()
    assert list(written) == ["DATE9.", "BEST9.3", "9.3", "DATE.", None]


def test_dictionary_classes_find_what_single_files_do(spark):
    schema = "logical_path string, column_index int, column_name string, column_format string, data_type string, x int"
    one = [(0, "A", None, "Double"), (1, "B", "DATE9.", "Date")]
    kinds = {"same": (one, one), "gone": (one[:1], one), "more": (one, one[:1]), "none": (one, []), "absent": ([], one),
             "other": ([(0, "A", "8.2", "Double"), one[1]], one), "null": ([(0, None, None, None)], [(0, "", None, None)])}
    sides = []
    for side in (0, 1):
        rows = [(f"{kind}/{i}", *c, i) for kind, both in kinds.items() for i in range(3) for c in both[side]]
        # a file that could not be read has a row without a column
        sides.append(spark.createDataFrame(rows + [("bad", None, None, None, None, 0)], schema))
    single = quality.dictionary_differences(*[s.where("column_index IS NOT NULL") for s in sides])
    want = sorted(map(str, (tuple(r) for r in single.where("endswith(logical_path, '/0')").collect())))
    classes = quality.dictionary_class_differences(*sides)
    got = classes.collect()
    assert sorted(str((r[0], *r[2:])) for r in got) == want and {r.files for r in got} == {3}
    assert {r.files for r in quality.dictionary_classes(sides[0]).collect()} == {9, 3}
    assert quality.dictionary_class_differences(sides[0].limit(0), sides[1].limit(0)).isEmpty()
    assert quality.dictionary_classes(sides[0].where("logical_path = 'bad'")).isEmpty()
