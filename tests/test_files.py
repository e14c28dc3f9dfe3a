"""Contents of files in ranges: all bytes, and none of them in a larger row."""

import pytest

import __spark_entry__ as entry_point
from cellframe.sources import files

LISTED = "logical_path string, length long"


def base(path):
    return path.rpartition("/")[2]


def test_scan_in_ranges_gives_all_bytes(spark, tmp_path):
    contents = {"none": b"", "one": b"a", "exact": b"abcdef", "more": b"abcdefg", "sub/more": bytes(range(256)) * 5}
    for name, content in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    rows = files.scan_files(spark, str(tmp_path), range_bytes=3).orderBy("logical_path", "offset").collect()
    found = {}
    for r in rows:
        before = found.setdefault(r.logical_path.removeprefix(f"file:{tmp_path}/"), b"")
        assert r.offset == len(before) and len(r.content) <= 3 and r.read_error is None
        found[r.logical_path.removeprefix(f"file:{tmp_path}/")] += r.content
    assert found == contents and len(rows) == 1 + 1 + 2 + 3 + 427
    limited = files.scan_files(spark, str(tmp_path), None, 6, range_bytes=3).collect()
    assert sorted(base(r.logical_path) for r in limited) == ["exact", "exact", "none", "one"]
    assert files.scan_files(spark, str(tmp_path), ".xpt", range_bytes=3).collect() == []


def test_range_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "short").write_bytes(b"abcd")
    lost = spark.createDataFrame([(f"file:{tmp_path}/gone", 5), (f"file:{tmp_path}/short", 5)], LISTED)
    rows = {(base(r.logical_path), r.offset): r for r in files.read_in_ranges(lost, 3).collect()}
    assert set(rows) == {(n, o) for n in ("gone", "short") for o in (0, 3)}
    assert all(rows["gone", o].content is None and "FileNotFound" in rows["gone", o].read_error for o in (0, 3))
    assert [rows["short", o].content for o in (0, 3)] == [b"abc", b"d"]


@pytest.fixture
def large(tmp_path):
    """A folder of one file, of which no machine need hold more than a part."""
    with open(tmp_path / "t.parquet", "wb") as out:
        out.write(b"PAR1")
        out.truncate((40 << 20) + 1)
    return str(tmp_path)


def test_scan_files_query_reads_all_in_ranges(spark, large, monkeypatch):
    asked = []

    def spy(ranges, *args, read=files.read_ranges):
        asked.append(ranges)
        return read(ranges, *args)

    monkeypatch.setattr(files, "read_ranges", spy)
    rows = entry_point.queries()["scan_files"](spark, large).collect()
    assert [tuple(r) for r in rows] == [("t.parquet", True, "PAR1")]
    placed = sorted((r.offset, r.size) for r in asked[0].collect())
    assert max(size for _, size in placed) <= 16 << 20
    assert sum(size for _, size in placed) == (40 << 20) + 1
    assert [o for o, _ in placed] == [sum(size for _, size in placed[:i]) for i in range(len(placed))]
    # Small rows that stand for large contents: they must not all go to one task.
    assert asked[0].rdd.getNumPartitions() > 1


def test_scan_files_query_tells_what_is_not_whole(spark, tmp_path, monkeypatch):
    for name in ("a/t", "b/t", "short", "empty", "later"):
        (tmp_path / f"{name}.parquet").parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.parquet").write_bytes(b"" if name == "empty" else b"PAR1" + bytes(6))
    listed = [("a/t", 10), ("b/t", 10), ("short", 11), ("empty", 0), ("gone", 10), ("later", 10)]
    frame = spark.createDataFrame([(f"file:{tmp_path}/{n}.parquet", size) for n, size in listed], LISTED)
    monkeypatch.setattr(files, "list_files", lambda *args: frame)
    monkeypatch.setattr(files, "RANGE_BYTES", 4)

    class Source:
        def __init__(self, path):
            self.path, self.inside = path, open(path.removeprefix("file:"), "rb")

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.inside.close()

        def seek(self, at):
            if at and self.path.endswith("/later.parquet"):
                raise OSError("it has gone since")
            self.inside.seek(at)

        def read(self, size):
            return self.inside.read(size)

    monkeypatch.setattr(files, "open_input", Source)
    rows = sorted((tuple(r) for r in entry_point.queries()["scan_files"](spark, str(tmp_path)).collect()), key=str)
    assert rows == [
        ("empty.parquet", True, ""),
        ("gone.parquet", None, None),
        ("later.parquet", None, None),
        ("short.parquet", False, "PAR1"),
        ("t.parquet", True, "PAR1"),
        ("t.parquet", True, "PAR1"),
    ]
