"""``.sas7bdat`` files: page ranges give the same cells as the whole file."""

import io
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

import cellframe as cf
from cellframe.sources import sas7bdat
from fixtures.sas7bdat import sas7bdat_files, write_sas7bdat
from fixtures.transport import Field

FIELDS = [
    Field("key"),
    Field("name", 12, True, label="Name of it", format="$CHAR", width=12),
    Field("day", 4, format="DATE", width=9),
    Field("share", format="BEST", width=9, decimals=3),
]


def rows(n):
    return [(float(i), f"n{i}é" if i % 3 else None, float(i % 20000), i / 7 if i % 5 else None) for i in range(n)]


def listed(cells) -> list[str]:
    return sorted(map(repr, cells.collect()))


KINDS = {
    "mixed": {},
    "plain": {"mixed": False},
    "packed": {"compress": True},
    "pages": {"page_size": 4096},
}


@pytest.fixture(scope="module")
def contents():
    out = {f"{k}.sas7bdat": write_sas7bdat(FIELDS, rows(2000), **o) for k, o in KINDS.items()}
    out["one.SAS7BDAT"] = write_sas7bdat(FIELDS, rows(1))
    out["none.sas7bdat"] = write_sas7bdat(FIELDS, [])
    out["cut.sas7bdat"] = write_sas7bdat(FIELDS, rows(2000))[:-1000]
    out["bad.sas7bdat"] = b"invalid sas content"
    for kind in ("mixed", "packed"):
        out[f"spoiled-{kind}.sas7bdat"] = out[f"{kind}.sas7bdat"].replace("n700é".encode(), b"n700\xff\xff", 1)
    return out


@pytest.fixture(scope="module")
def files(spark, contents):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in contents.items()], cf.FILE_SCHEMA)


def test_cells(spark, files, contents):
    cells = cf.parse_files(files)
    assert cf.matches_contract(cells)
    found = {}
    for r in cells.orderBy("row_index", "column_index").collect():
        found.setdefault(r.logical_path, []).append(r)
    for kind in KINDS:
        got = found[f"{kind}.sas7bdat"]
        assert len(got) == 8000 and not any(r.error_msg for r in got)
        assert [r.row_index for r in got[::4]] == list(range(2000))
        assert [r.value_double for r in got[::4]] == [float(i) for i in range(2000)]
        assert [r.value_string for r in got[1::4]] == [v[1] or "" for v in rows(2000)]
        assert [r.value_double for r in got[3::4]] == [v[3] for v in rows(2000)]
        assert got[2].value_date == date(1960, 1, 1) and got[6].value_date == date(1960, 1, 2)
        assert [(r.column_name, r.column_label, r.column_format, r.data_type) for r in got[:4]] == [
            ("key", None, None, "Double"),
            ("name", "Name of it", "$CHAR12.", "String"),
            ("day", None, "DATE9.", "Date"),
            ("share", None, "BEST9.3", "Double"),
        ]
    assert len(found["one.SAS7BDAT"]) == 4
    assert [r.error_msg for r in found["none.sas7bdat"]] == ["Empty SAS dataset"]
    assert [r.error_msg for r in found["bad.sas7bdat"]] == [
        "Failed to parse SAS file: magic number mismatch (not a SAS file?)"
    ]
    # the last page is short: all rows up to it, then one error row
    cut = found["cut.sas7bdat"]
    errors = [r for r in cut if r.error_msg]
    assert [r.error_msg for r in errors] == ["Failed to get next row: the file ends inside a page"]
    last = sas7bdat.PageShape(contents["cut.sas7bdat"][:288]).page_size
    layout = sas7bdat.read_layout(io.BytesIO(contents["cut.sas7bdat"]), contents["cut.sas7bdat"], last)
    kept = 2000 - layout["range_rows"][-1]
    assert 1000 < kept < 2000
    assert [repr(r) for r in cut if not r.error_msg] == [
        repr(r).replace("mixed.", "cut.") for r in found["mixed.sas7bdat"][: 4 * kept]
    ]
    # a byte that is no text spoils its cell only
    for kind in ("mixed", "packed"):
        spoiled = found[f"spoiled-{kind}.sas7bdat"]
        bad = [r for r in spoiled if r.error_msg]
        assert [(r.row_index, r.column_name, r.error_msg) for r in bad] == [
            (700, "name", "Failed to get value: the bytes are not UTF-8 text")
        ]
        good = [repr(r).replace(f"{kind}.sas", f"spoiled-{kind}.sas") for r in found[f"{kind}.sas7bdat"]]
        assert [repr(r) for r in spoiled if not r.error_msg] == good[:2801] + good[2802:]


def test_ranges_give_the_same_cells(files):
    whole = sas7bdat.scan_sas7bdat(files)
    pieces = sas7bdat.scan_sas7bdat(files, range_bytes=10_000)
    found = listed(whole)
    assert len(found) > 6 * 8000 + 4 + 2 + 4 * 1000
    assert listed(pieces) == found


def test_large_files_are_read_by_ranges(spark, files, contents, tmp_path):
    listing = []
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
        listing.append((f"file:{tmp_path}/{name}", len(content)))
    on_disk = spark.createDataFrame(listing, "logical_path string, length bigint")
    pieces = sas7bdat.scan_large_sas7bdat(on_disk, range_bytes=10_000).selectExpr(
        "substring_index(logical_path, '/', -1) AS logical_path", "* EXCEPT (logical_path)"
    )
    assert listed(pieces) == listed(sas7bdat.scan_sas7bdat(files))


def test_each_file_is_made_and_laid_out_once(spark):
    """Files of no interest to a branch are not made for it; files that cannot be read need no second look at all of them."""
    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS key", "id AS n")
    path = F.concat(F.lit("f"), F.floor(F.col("n") / 100).cast("string"), F.lit(".sas7bdat"))
    written = sas7bdat_files(df, path, ["key"], FIELDS[:1])
    plan = cf.parse_files(written)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("MapInArrow") == 1
    lines = plan.splitlines()
    made = [n for n, line in enumerate(lines) if "write(" in line]
    assert 1 <= len(made) <= 2 and "FlatMapGroupsInPandas" not in plan
    assert all("Filter" in "".join(lines[n + 1 : n + 3]) for n in made)  # for files of one format, told by their paths
    cells = cf.parse_files(written)
    assert cells.count() == 1000 and cells.where("logical_path = 'f3.sas7bdat' AND row_index = 7").first().value_double == 307.0


@pytest.mark.parametrize("options", KINDS.values(), ids=KINDS)
def test_row_counts_of_pages(options):
    content = write_sas7bdat(FIELDS, rows(700), **options)
    assert len(pd.read_sas(io.BytesIO(content), format="sas7bdat")) == 700
    layout = sas7bdat.read_layout(io.BytesIO(content), content, range_bytes=8192)
    assert layout["prefix_rows"] + sum(layout["range_rows"]) == 700
