"""Transport files: decoding, padding, and every way a file can be wrong."""

import io
import math
import re
import struct
from datetime import date, datetime

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

import cellframe as cf
from cellframe.operators import quality
from cellframe.sources import files, xpt
from fixtures.transport import Field, bits_bytes, card, extended_header, header, hex_float_steps, pad_card
from pyspark.sql import functions as F


def number(v: float | None) -> bytes:
    """A base-16 float by exact integer arithmetic, independent of the Spark encoder."""
    if v is None:
        return b"." + bytes(7)
    if v == 0:
        return bytes(8)
    m, e = math.frexp(abs(v))
    shift = -e % 4
    fraction = int(m * 2**53) << 3 >> shift
    return struct.pack(">Q", ((v < 0) << 63) | (((e + shift) // 4 + 64) << 56) | fraction)


def write(fields, rows, **options) -> bytes:
    data = b""
    for row in rows:
        for f, v in zip(fields, row):
            data += (v if isinstance(v, bytes) else v.encode()).ljust(f.size)[: f.size] if f.text else number(v)[: f.size]
    return header(fields, **options) + pad_card(data)


def frame(spark, files: dict[str, bytes | None]):
    rows = [(k, None if v is None else bytearray(v)) for k, v in files.items()]
    return spark.createDataFrame(rows, cf.FILE_SCHEMA)


def listed(cells) -> list[str]:
    return sorted(map(repr, cells.collect()))


def parsed(spark, files, parse=xpt.scan_xpt, **options) -> dict[str, list]:
    cells = parse(frame(spark, files), **options)
    assert cf.matches_contract(cells)
    out: dict[str, list] = {k: [] for k in files}
    for row in cells.orderBy("logical_path", "row_index", "column_index").collect():
        out[row.logical_path].append(row)
    return out


# Names and formats of the 14-column test dataset and the types they stand for.
GOLDEN = [
    ("VAR01", "BEST", 9, 3, "BEST9.3", "Double"),
    ("VAR02", "", 9, 3, "9.3", "Double"),
    ("VAR03", "DATE", 0, 0, "DATE.", "Date"),
    ("VAR04", "DATE", 7, 0, "DATE7.", "Date"),
    ("VAR05", "DATE", 9, 0, "DATE9.", "Date"),
    ("VAR06", "YYMMDD", 0, 0, "YYMMDD.", "Date"),
    ("VAR07", "YYMMDD", 8, 0, "YYMMDD8.", "Date"),
    ("VAR08", "YYMMDD", 10, 0, "YYMMDD10.", "Date"),
    ("VAR09", "TIME", 0, 0, "TIME.", "Time"),
    ("VAR10", "TIME", 5, 0, "TIME5.", "Time"),
    ("VAR11", "TIME", 8, 0, "TIME8.", "Time"),
    ("VAR12", "HHMM", 0, 0, "HHMM.", "Time"),
    ("VAR13", "HHMM", 5, 0, "HHMM5.", "Time"),
    ("VAR14", "DATETIME", 0, 0, "DATETIME.", "Timestamp"),
]


def test_fourteen_formats(spark):
    fields = [Field(n, format=f, width=w, decimals=d) for n, f, w, d, *_ in GOLDEN]
    values = [1.5, -2.25] + [21915.0] * 6 + [93784.0] * 5 + [21915 * 86400 + 0.5]
    cells = parsed(spark, {"f.xpt": write(fields, [values], label="Formats")})["f.xpt"]
    assert [(c.column_name, c.column_format, c.data_type) for c in cells] == [(g[0], g[4], g[5]) for g in GOLDEN]
    assert len(cells) == 14 and {c.dataset_label for c in cells} == {"Formats"}
    assert [c.value_double for c in cells[:2]] == [1.5, -2.25]
    assert {c.value_date for c in cells[2:8]} == {date(2020, 1, 1)}
    assert {(c.value_time, c.value_string) for c in cells[8:13]} == {(93784, "26:03:04")}
    assert cells[13].value_timestamp == datetime(2020, 1, 1, 0, 0, 0, 500000)
    assert all(c.error_msg is None and c.row_index == 0 for c in cells)


CLASS = [Field("NAME", 8, True), Field("SEX", 1, True), Field("AGE"), Field("HEIGHT"), Field("WEIGHT")]


def test_same_as_an_independent_reader(spark):
    rows = [("Alfred", "M", 14.0, 69.0, 112.5), ("Änne", "F", None, 56.5, 1e-9), ("", "", 0.0, -1e20, 1 / 3)]
    content = write(CLASS, rows)
    expected = pd.read_sas(io.BytesIO(content), format="xport", encoding="utf-8")
    cells = parsed(spark, {"c.xpt": content})["c.xpt"]
    assert [c.data_type for c in cells[:5]] == ["String", "String", "Double", "Double", "Double"]
    for c in cells:
        theirs = expected.iloc[c.row_index, c.column_index]
        if c.data_type == "String":
            assert c.value_string == theirs
        elif c.value_double is None:
            assert math.isnan(theirs)
        else:
            assert c.value_double == pytest.approx(theirs, abs=1e-70)


def test_bad_files_become_error_rows(spark):
    good = write(CLASS, [("a", "b", 1.0, 2.0, 3.0)])
    second = write(CLASS, [("a", "b", 1.0, 2.0, 3.0)], member="OTHER", library=False)
    out = parsed(
        spark,
        {
            "good.xpt": good,
            "GOOD.XPT": good,
            "empty.xpt": write(CLASS, []),
            "two.xpt": good + second,
            "none.xpt": good[:240],
            "junk.xpt": b"dummy",
            "zero.xpt": b"",
            "null.xpt": None,
            "count.xpt": good[:614] + b"xxxx" + good[618:],
            "sizes.xpt": good[:644] + b"\xff\xff" + good[646:],
            "cut.xpt": good[:-75],
            "head.xpt": good[:700],
            "test.txt": b"dummy content",
            "test.xyz": b"content",
        },
        cf.parse_files,
    )
    message = {k: [r.error_msg for r in v if r.error_msg] for k, v in out.items()}
    assert len(out["good.xpt"]) == len(out["GOOD.XPT"]) == 5
    assert message.pop("good.xpt") == message.pop("GOOD.XPT") == []
    failed = "Failed to read XPT file: "
    assert message == {
        "empty.xpt": ["Empty SAS dataset"],
        "two.xpt": [failed + "A single table in XPT-file is supported, found 2: DATA, OTHER"],
        "none.xpt": [failed + "A single table in XPT-file is supported, found 0: "],
        "junk.xpt": [failed + "not a transport file"],
        "zero.xpt": [failed + "not a transport file"],
        "null.xpt": [failed + "no content"],
        "count.xpt": [failed + "bad column count"],
        "sizes.xpt": ["Failed to get next row: the file ends inside a record"],
        "cut.xpt": ["Failed to get next row: the file ends inside a record"],
        "head.xpt": [failed + "no observation header"],
        "test.txt": ["Unsupported SAS dataset (only .sas7bdat and .xpt supported): test.txt"],
        "test.xyz": ["Unsupported SAS dataset (only .sas7bdat and .xpt supported): test.xyz"],
    }
    for rows in out.values():
        for row in rows:
            if row.error_msg:
                assert [v for v in row if v is not None] == [row.logical_path, row.error_msg]


def test_padding_is_not_a_record(spark):
    files, wanted = {}, {}
    for size in (1, 7, 8, 39, 40, 41, 79, 80, 81, 100, 160):
        for n in range(1, 12):
            name = f"{size}-{n}.xpt"
            files[name] = write([Field("T", size, True)], [(f"x{i}"[:size],) for i in range(n)])
            wanted[name] = n
    assert {k: len(v) for k, v in parsed(spark, files).items()} == wanted


def test_text_that_is_no_text(spark):
    content = write([Field("T", 8, True), Field("N")], [(b"caf\xe9", 1.0), ("ok", 2.0)])
    utf8 = parsed(spark, {"t.xpt": content})["t.xpt"]
    assert [c.error_msg for c in utf8] == ["Failed to get value: the bytes are not UTF-8 text", None, None, None]
    assert utf8[0].column_name == "T" and utf8[0].value_string is None
    latin = parsed(spark, {"t.xpt": content}, encoding="ISO-8859-1")["t.xpt"]
    assert [c.value_string for c in latin] == ["café", None, "ok", None]
    with pytest.raises(ValueError, match="encoding"):
        cf.parse_files(frame(spark, {"t.xpt": content}), encoding="ebcdic")


def test_short_numbers_missing_marks_and_old_descriptors(spark):
    fields = [Field("A", 2), Field("B", 3), Field("TOD", format="TOD", width=8)]
    content = header(fields, descriptor=136) + pad_card(
        number(1.0)[:2] + number(-256.0)[:3] + number(-1.0) + b"_\0" + b"Z\0\0" + b"A" + bytes(7)
    )
    cells = parsed(spark, {"s.xpt": content})["s.xpt"]
    assert [c.value_double for c in cells] == [1.0, -256.0, None, None, None, None]
    assert (cells[2].value_time, cells[2].value_string) == (86399, "23:59:59")
    assert (cells[5].data_type, cells[5].value_time, cells[5].value_string) == ("Time", None, None)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(min_value=-7e75, max_value=7e75).filter(lambda v: v == 0 or abs(v) > 1e-77), min_size=50, max_size=400))
def test_doubles_round_trip(spark, values):
    content = write([Field("V")], [(v,) for v in values])
    cells = parsed(spark, {"v.xpt": content})["v.xpt"]
    assert [c.value_double for c in cells] == values
    encoded = hex_float_steps(spark.createDataFrame([(v,) for v in values], "v double"), ["v"])
    assert [bytes(r[0]) for r in encoded.select(bits_bytes(F.col("v"))).collect()] == [number(v) for v in values]


def test_chunks_give_the_same_cells(spark):
    fields = [Field("K"), Field("T", 5, True)]
    files = frame(spark, {"a.xpt": write(fields, [(float(i), f"t{i % 100}") for i in range(1000)])})
    whole = xpt.scan_xpt(files)
    pieces = xpt.scan_xpt(files, chunk_bytes=1)
    assert listed(whole) == listed(pieces) and whole.count() == 2000


def test_large_files_are_read_by_ranges(spark, tmp_path):
    fields = [Field("K"), Field("T", 5, True)]
    rows = [(float(i), f"t{i % 100}") for i in range(1000)]
    good, cut = write(fields, rows), write(fields, rows)[:-45]
    many = header([Field(f"V{i}") for i in range(300)]) + pad_card(number(7.0) * 300)
    two = good + write(fields, rows, member="SECOND", library=False)
    # a second member behind the last whole record, and members that are not in the order of their names
    wide = write([Field("T", 2_000, True)], [("x",)])
    behind = wide + write(fields, [], member="OTHER", library=False)
    three = good + write(fields, rows, member="ZZZ", library=False) + write(fields, rows[:3], member="BBB", library=False)
    contents = {"good": good, "cut": cut, "many": many, "two": two, "junk": b"dummy", "empty": write(fields, []),
                "behind": behind, "three": three}
    for name, content in contents.items():
        (tmp_path / f"{name}.xpt").write_bytes(content)
    (tmp_path / "other.txt").write_bytes(b"x")
    small = cf.read_files(spark, str(tmp_path))
    large = cf.read_files(spark, str(tmp_path), whole_file_bytes=-1)
    in_pieces = xpt.scan_large_xpt(
        spark.createDataFrame([(f"file:{tmp_path}/{n}.xpt", len(c)) for n, c in contents.items()],
                              "logical_path string, length bigint"),
        chunk_bytes=100,
    )
    found = listed(small)
    assert len(found) == 2000 + 1998 + 1 + 300 + 1 + 1 + 1 + 1 + 2
    messages = {r.logical_path.rpartition("/")[2]: r.error_msg for r in small.where("error_msg LIKE '%found%'").collect()}
    table_count = "Failed to read XPT file: A single table in XPT-file is supported, found "
    assert messages == {"two.xpt": table_count + "2: DATA, SECOND", "behind.xpt": table_count + "2: DATA, OTHER",
                        "three.xpt": table_count + "3: DATA, ZZZ, BBB"}
    assert listed(large) == found
    assert listed(in_pieces) == [r for r in found if ".txt" not in r]
    assert listed(cf.read_files(spark, str(tmp_path), whole_file_bytes=0)) == found
    found = xpt.read_dictionary(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content#" not in plan and plan.count("BatchScan dataset_files") == 1 and plan.count("MapInArrow") == 1
    names = {}
    for r in found.orderBy("column_index").collect():
        names.setdefault(r.logical_path.rpartition("/")[2], []).append(r.error_msg or r.column_name)
    assert names["good.xpt"] == names["empty.xpt"] == ["K", "T"] and len(names["many.xpt"]) == 300
    assert names["junk.xpt"] == ["Failed to read XPT file: not a transport file"]
    missing = spark.createDataFrame([(f"file:{tmp_path}/gone.xpt", 900)], "logical_path string, length bigint")
    (row,) = xpt.scan_large_xpt(missing).collect()
    assert row.error_msg.startswith("Failed to read XPT file: FileNotFoundError")


def test_records_are_decoded_in_the_jvm(spark):
    plan = xpt.scan_xpt(frame(spark, {"a.xpt": b"x"}))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan


def test_unsupported_kinds_spoil_their_column_only(spark):
    content = write([Field("N"), Field("X"), Field("T", 3, True)], [(1.0, 2.0, "abc"), (3.0, 4.0, "def")])
    at = xpt.COLUMNS_AT + 140
    content = content[:at] + b"\0\7" + content[at + 2:]
    cells = parsed(spark, {"k.xpt": content})["k.xpt"]
    assert [(c.column_name, c.data_type, c.value_double, c.value_string, c.error_msg) for c in cells] == [
        ("N", "Double", 1.0, None, None), ("X", None, None, None, "Unsupported data type 7"),
        ("T", "String", None, "abc", None), ("N", "Double", 3.0, None, None),
        ("X", None, None, None, "Unsupported data type 7"), ("T", "String", None, "def", None),
    ]


def test_card_text():
    assert len(card("OBS")) == 80


# --- the extended layout --------------------------------------------------------------------------


def golden_extended(with_formats: bool) -> bytes:
    """A file of the extended layout, written down card by card."""
    def line(text: bytes) -> bytes:
        assert len(text) <= 80
        return text.ljust(80)

    zeros = b"0" * 30
    out = line(b"HEADER RECORD*******LIBV8   HEADER RECORD!!!!!!!" + zeros)
    out += line(b"SAS     SAS     SASLIB  9.4     X64_10HO" + b" " * 24 + b"02DEC26:10:11:12") + line(b"02DEC26:10:11:12")
    out += line(b"HEADER RECORD*******MEMBV8  HEADER RECORD!!!!!!!000000000000000001600000000140")
    out += line(b"HEADER RECORD*******DSCPTV8 HEADER RECORD!!!!!!!" + zeros)
    out += line(b"SAS     " + b"patients_of_the_second_study".ljust(32) + b"SASDATA 9.4     X64_10HO02DEC26:10:11:12")
    out += line(b"02DEC26:10:11:12" + b" " * 16 + b"All patients".ljust(40))
    out += line(b"HEADER RECORD*******NAMSTV8 HEADER RECORD!!!!!!!000000000200000000000000000000")
    first = b"\0\1\0\0\0\x08\0\1" + b"date_of_" + b"The day on which a patient was first see" + b"DATE    "
    first += b"\0\x09\0\0\0\0\0\0" + b" " * 8 + b"\0\0\0\0" + b"\0\0\0\0" + b"date_of_first_visit_of_a_patient"
    first += b"\0\x37" + b"\0" * 18
    second = b"\0\2\0\0\1\x2c\0\2" + b"note    " + b"Note".ljust(40) + b" " * 8 + b"\0" * 8 + b" " * 8 + b"\0\0\0\0"
    second += b"\0\0\0\x08" + b"note".ljust(32) + b"\0\4" + b"\0" * 18
    assert len(first) == len(second) == 140
    out += (first + second).ljust(320)
    label, name = b"The day on which a patient was first seen by a physician", b"date_of_first_visit_of_a_patient"
    if with_formats:
        out += line(b"HEADER RECORD*******LABELV9 HEADER RECORD!!!!!!!1")
        record = b"\0\1\0\x20\0\x38\0\x0e\0\0" + name + label + b"DATEAMPMLONG9."
    else:
        out += line(b"HEADER RECORD*******LABELV8 HEADER RECORD!!!!!!!1")
        record = b"\0\1\0\x20\0\x38" + name + label
    out += record.ljust(-(-len(record) // 80) * 80)
    out += line(b"HEADER RECORD*******OBSV8   HEADER RECORD!!!!!!!" + zeros)
    rows = b"\x44\x55\x9b\0\0\0\0\0" + b"x" * 290 + b" " * 10 + b".\0\0\0\0\0\0\0" + b"second".ljust(300)
    return out + rows.ljust(-(-len(rows) // 80) * 80)


@pytest.mark.parametrize("with_formats", [False, True])
def test_extended_golden_file(spark, with_formats):
    cells = parsed(spark, {"g.xpt": golden_extended(with_formats)})["g.xpt"]
    assert [(c.row_index, c.column_name, c.data_type, c.value_date, c.value_string) for c in cells] == [
        (0, "date_of_first_visit_of_a_patient", "Date", date(2020, 1, 1), None), (0, "note", "String", None, "x" * 290),
        (1, "date_of_first_visit_of_a_patient", "Date", None, None), (1, "note", "String", None, "second"),
    ]
    assert cells[0].column_label == "The day on which a patient was first seen by a physician"
    assert cells[0].column_format == ("DATEAMPMLONG9." if with_formats else "DATE9.") and cells[1].column_format is None
    assert {c.dataset_label for c in cells} == {"All patients"} and not any(c.error_msg for c in cells)


def test_extended_layout_by_content_and_by_ranges(spark, tmp_path):
    fields = [Field(f"a_long_name_of_column_{i:04d}", 4 if i % 3 else 200, not i % 3, "label " * (i % 40), "DATETIMEAMPM" if i % 7 == 1 else "")
              for i in range(400)]
    row = [("t" if f.text else 1.5) for f in fields]

    def extended(rows, head=None, **options):
        data = b"".join((v.encode().ljust(f.size) if f.text else number(v)[: f.size]) for r in rows for f, v in zip(fields, r))
        return (head or extended_header(fields, **options)) + pad_card(data)

    plain = extended_header([Field("K"), Field("T", 5, True)])
    whole = extended([row] * 3)
    at = whole.index(card("OBSV8")[:48])
    labels_at = whole.index(b"HEADER RECORD*******LABELV9") + 48
    contents = {
        "many": whole, "short": plain + pad_card(number(2.0) + b"abc  "), "none": extended([]),
        "two": whole + extended([row], member="SECOND_MEMBER_WITH_A_LONG_NAME", library=False),
        "cut": whole[:-300], "in_labels": whole[: at - 2_000], "in_descriptors": whole[:9_000],
        "no_number": whole[:labels_at] + b"x" * 5 + whole[labels_at + 5:],
        "too_many": whole[:labels_at] + b"32767" + whole[labels_at + 5:],
        "empty": b"",
    }
    for name, content in contents.items():
        (tmp_path / f"{name}.xpt").write_bytes(content)
    (tmp_path / "empty.sas7bdat").write_bytes(b"")
    small = cf.read_files(spark, str(tmp_path))
    found = listed(small)
    assert listed(cf.read_files(spark, str(tmp_path), whole_file_bytes=-1)) == found
    assert listed(cf.read_files(spark, str(tmp_path), whole_file_bytes=20_000)) == found
    errors = {r.logical_path.rpartition("/")[2]: r.error_msg for r in small.where("error_msg IS NOT NULL").collect()}
    refused = "Failed to read XPT file: "
    assert errors.pop("two.xpt") == refused + "A single table in XPT-file is supported, found 2: DATA, SECOND_MEMBER_WITH_A_LONG_NAME"
    assert errors.pop("none.xpt") == "Empty SAS dataset" and errors.pop("empty.xpt") == refused + "not a transport file"
    assert errors.pop("empty.sas7bdat").startswith("Failed to parse SAS file: ")
    assert errors.pop("cut.xpt") == "Failed to get next row: the file ends inside a record"
    assert errors == {f"{n}.xpt": refused + "no observation header" for n in ("in_labels", "in_descriptors", "no_number", "too_many")}
    assert len(found) == 400 * 3 + 2 + 1 + 1 + 400 * 2 + 1 + 4 + 2
    cells = small.where("logical_path LIKE '%many.xpt' AND row_index = 2").orderBy("column_index").collect()
    assert [(c.column_name, c.column_label, c.column_format) for c in cells] == [
        (f.name, f.label.strip() or None, "DATETIMEAMPM." if f.format else None) for f in fields]
    dictionary = xpt.read_dictionary(spark, str(tmp_path))
    counted = {r.logical_path.rpartition("/")[2]: r.n for r in dictionary.groupBy("logical_path").agg(F.count("column_name").alias("n")).collect()}
    assert counted["many.xpt"] == counted["none.xpt"] == 400 and counted["short.xpt"] == 2 and counted["empty.xpt"] == 0
    counts = {r.logical_path.rpartition("/")[2]: (r.n_rows, r.cells) for r in xpt.read_counts(spark, str(tmp_path)).collect()}
    assert counts["many.xpt"] == (3, 1200) and counts["cut.xpt"] == (2, 800) and counts["none.xpt"] == (0, 0)
    plan = xpt.read_counts(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content#" not in plan and plan.count("MapInArrow") == 1


def test_code_pages(spark):
    text = "Ž€—“naïve”"
    fields = [Field("T", 12, True, "Größe …")]
    for encoding in ("windows-1252", "CP1252"):
        content = header(fields, label="für 5 €", text="cp1252") + pad_card(text.encode("cp1252").ljust(12) + b"a\x81b".ljust(12))
        good, bad = parsed(spark, {"w.xpt": content}, encoding=encoding)["w.xpt"]
        assert (good.value_string, good.dataset_label, good.column_label) == (text, "für 5 €", "Größe …")
        assert bad.value_string is None and bad.error_msg == f"Failed to get value: the bytes are not {encoding} text"
    for encoding in ("iso8859-15", "cp1251", "koi8-r", "cp437", "cp1250", "cp874"):
        every = bytes(range(128, 256))
        known = b"".join(bytes([b]) for b in every if bytes([b]).decode(encoding, "ignore"))
        content = header([Field("T", 200, True)]) + pad_card((b"'\\%_" + known).ljust(200))
        (cell,) = parsed(spark, {"w.xpt": content}, encoding=encoding)["w.xpt"]
        assert cell.value_string == "'\\%_" + known.decode(encoding).rstrip(" ")
    for encoding in ("utf-16", "cp037", "shift_jis", "no such", "hex"):
        with pytest.raises(ValueError):
            xpt.scan_xpt(frame(spark, {}), encoding=encoding)


# --- files ----------------------------------------------------------------------------------------


def test_first_rows_read_no_other_records(spark, tmp_path):
    fields = [Field("K"), Field("T", 5, True)]
    many = write(fields, [(float(i), f"t{i}") for i in range(1000)])
    few = write(fields, [(float(i), "x") for i in range(20)])
    contents = {"a": b"", "b": few[:-45], "c": b"junk", "d": write(fields, []), "e": many, "f": few, "g": many}
    for name, content in contents.items():
        (tmp_path / f"{name}.xpt").write_bytes(content)
    (tmp_path / "aa.txt").write_bytes(b"x")
    cells = cf.read_files(spark, str(tmp_path)).where("endswith(logical_path, '.xpt')")
    every = [tuple(r) for r in quality.sample_cells(cells, 100_000).collect()]
    heads = xpt.read_headers(
        xpt._fetched_heads(files.list_files(spark, str(tmp_path), ".xpt")), "UTF-8", xpt.FORMAT_PREFIXES).cache()
    for n in (1, 2, 3, 41, 42, 43, 2043, 2083, 5000):
        planned = xpt._first_rows(heads, n).where("file_error IS NULL").agg(F.sum("rows")).first()[0] or 0
        assert planned == len({(r[0], r[2]) for r in every[:n] if r[2] is not None})
    for n in (3, 43, 2083):
        assert [tuple(r) for r in xpt.read_first(spark, str(tmp_path), n).collect()] == every[:n]


def test_listing_and_writing(spark, tmp_path):
    inside = {"a/x y%20.xpt": b"", "a/b/c.sas7bdat": None, "z.XPT": b"abc", "t.txt": b"q", "a/_hidden.xpt": b"s", "_d/k.xpt": b"s"}
    written = files.write_files(frame(spark, inside), str(tmp_path / "new"))
    assert {(r.logical_path.removeprefix(f"{tmp_path}/new/"), r.length) for r in written.collect()} == {
        (k, len(v or b"")) for k, v in inside.items()}
    for path in (str(tmp_path / "new"), f"file:{tmp_path}/new", f"file://{tmp_path}/new/"):
        rows = {r.logical_path.rpartition("/new/")[2]: r.length for r in files.list_files(spark, path).collect()}
        assert rows == {k: len(v or b"") for k, v in inside.items() if "_" not in k}
    def names(*args):
        return sorted(r.logical_path.rpartition("/")[2] for r in files.list_files(spark, *args).collect())
    assert names(f"{tmp_path}/new/a/*.xpt") == ["x y%20.xpt"] and names(str(tmp_path), ".xpt") == ["x y%20.xpt", "z.XPT"]
    assert names([f"{tmp_path}/new/t.txt", f"{tmp_path}/new/a/b"]) == ["c.sas7bdat", "t.txt"]
    whole = {r.logical_path.rpartition("/")[2]: r.content for r in files.scan_files(spark, str(tmp_path), None, 2).collect()}
    assert whole == {"x y%20.xpt": b"", "c.sas7bdat": b"", "t.txt": b"q"}
    for bad in ("/abs", "../up", "a/../../up"):
        with pytest.raises(Exception, match="does not lie below"):
            files.write_files(frame(spark, {bad: b""}), str(tmp_path / "new")).collect()
    with pytest.raises(Exception, match="FileNotFoundError"):
        files.list_files(spark, str(tmp_path / "gone")).collect()
    lost = spark.createDataFrame([(f"file:{tmp_path}/gone.xpt", 9), ("nostore://x/y", 1)], "logical_path string, length long")
    errors = {r.logical_path: r.read_error for r in files.read_whole(lost).collect()}
    assert errors[f"file:{tmp_path}/gone.xpt"].startswith("FileNotFoundError") and "nostore" in errors["nostore://x/y"]
