"""Files as rows: listing, whole content, byte ranges, and writing them.

All of this goes through one file system layer on the executors, Arrow's (and fsspec's for stores Arrow has no name for,
where that is installed), so a file of any size is found and read in the same way.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Scheme names of Hadoop paths and of the same store in Arrow.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "file": "file"}
_WILD = re.compile(r"[*?\[]")

#: Contents that are read in ranges come in rows of so many bytes: the tasks of a machine hold a few of them each.
RANGE_BYTES = 4 << 20


def open_store(path: str):
    """The file system of a path as Spark writes it, and the path inside it."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        place = path if not colon else "/" + rest.lstrip("/")
        return fs.LocalFileSystem(), posixpath.abspath(place)
    uri = f"{_ARROW_SCHEMES.get(scheme, scheme)}:{rest}"
    try:
        return fs.FileSystem.from_uri(uri)
    except pa.ArrowInvalid:
        try:
            import fsspec
        except ImportError:
            raise ValueError(f"no file system is known for {scheme}:") from None
        store, place = fsspec.core.url_to_fs(path)
        return fs.PyFileSystem(fs.FSSpecHandler(store)), place


def open_input(path: str):
    """A seekable reader of a path, on an executor."""
    store, place = open_store(path)
    return store.open_input_file(place)


# --- listing -------------------------------------------------------------------------------------


class Folder(InputPartition):
    """Files of one folder, or of all folders below it; ``pattern`` restricts their paths."""

    def __init__(self, path: str, deep: bool, pattern: str | None):
        super().__init__(path)
        self.path, self.deep, self.pattern = path, deep, pattern


def _hidden(relative: str) -> bool:
    """As Spark's own file sources have it."""
    return any(part.startswith(("_", ".")) for part in relative.split("/") if part)


def _below(path: str, deep: bool) -> Iterator[tuple[str, object]]:
    """(path as given with what is below it, Arrow's description) of a file, or of what is in a folder."""
    from pyarrow import fs

    store, place = open_store(path)
    info = store.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    root = path if ":" in path else f"file:{place}"
    if info.type == fs.FileType.File:
        yield root, info
        return
    for entry in store.get_file_info(fs.FileSelector(place, recursive=deep)):
        relative = entry.path[len(place.rstrip("/")):].lstrip("/")
        if not _hidden(relative):
            yield f"{root.rstrip('/')}/{relative}", entry


class FileListing(DataSource):
    """(logical_path, length) of the files below some paths, those without a byte included.

    Planning looks at the top of each path only; a folder found there is one partition, whose task lists all below it.
    """

    @classmethod
    def name(cls) -> str:
        return "dataset_files"

    def schema(self) -> str:
        return "logical_path string, length bigint"

    def reader(self, schema) -> DataSourceReader:
        return FileListingReader(json.loads(self.options["paths"]))


class FileListingReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        found = []
        for path in self.paths:
            pattern = None
            if _WILD.search(path):
                pattern = path if ":" in path else f"file:{posixpath.abspath(path)}"
                path = path[: path.rindex("/", 0, _WILD.search(path).start()) + 1] if "/" in path else "."
            found.append(Folder(path, False, pattern))
            found += [
                Folder(below, True, pattern) for below, info in _below(path, False) if info.type == fs.FileType.Directory
            ]
        return found

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        rows = [
            (path, info.size) for path, info in _below(partition.path, partition.deep)
            if info.type == fs.FileType.File and (partition.pattern is None or fnmatchcase(path, partition.pattern))
        ]
        paths, sizes = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["logical_path", "length"]
        )


def list_files(spark: SparkSession, path: str | list[str], ending: str | None = None) -> DataFrame:
    """Path and length of each file below ``path``, a file, a folder, a pattern, or a list of them.

    No content is read. ``ending`` is compared in lower case. Rows are spread over the cluster, whatever folders the
    files lie in.
    """
    spark.dataSource.register(FileListing)
    paths = [path] if isinstance(path, str) else list(path)
    files = spark.read.format(FileListing.name()).option("paths", json.dumps(paths)).load()
    if ending is not None:
        files = files.where(F.lower("logical_path").endswith(ending))
    return files.repartition("logical_path")


# --- contents ------------------------------------------------------------------------------------


def scan_files(
    spark: SparkSession,
    path: str | list[str],
    ending: str | None = None,
    max_bytes: int | None = None,
    range_bytes: int | None = None,
) -> DataFrame:
    """Path, length and whole content of each file, not opening those longer than ``max_bytes``.

    A file that cannot be read has null content and says why in ``read_error``. With ``range_bytes``, a file's content
    comes in rows of so many bytes, see ``read_in_ranges``: for files that may be larger than a task's memory.
    """
    files = list_files(spark, path, ending)
    if max_bytes is not None:
        files = files.where(F.col("length") <= max_bytes)
    return read_whole(files) if range_bytes is None else read_in_ranges(files, range_bytes)


def read_whole(listing: DataFrame) -> DataFrame:
    """The contents of listed files, a row each."""
    placed = listing.selectExpr("logical_path", "length", "0L AS offset", "length AS size")
    return read_ranges(placed, "content").selectExpr("logical_path", "length", "content", "range_error AS read_error")


def read_in_ranges(listing: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The whole contents of listed files, a row for each ``range_bytes`` of one, with its ``offset``.

    A file without a byte is one row. A range that cannot be read has null content, as a file has in ``read_whole``.
    """
    placed = listing.selectExpr(
        "logical_path", "length", f"explode(sequence(0L, greatest(length - 1, 0L), {range_bytes}L)) AS offset"
    ).selectExpr("*", f"CASE WHEN length - offset > {range_bytes} THEN {range_bytes}L ELSE length - offset END AS size")
    # By number: adaptive execution goes by the size of these small rows, and would have one task read all files.
    tasks = int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return read_ranges(placed.repartition(tasks, "logical_path", "offset"), "content").selectExpr(
        "logical_path", "length", "offset", "content", "range_error AS read_error"
    )


def read_ranges(ranges: DataFrame, into: str = "bytes") -> DataFrame:
    """Add the bytes at (``logical_path``, ``offset``, ``size``) of each row.

    Only the small range rows move between tasks; every task fetches its own bytes
    from the shared store, so one huge file is read by as many tasks as it has
    ranges, and a lost task just reads its ranges again. A range that cannot be read
    gives null bytes and the reason in ``range_error``.
    """
    schema = T.StructType(
        [
            *ranges.schema.fields,
            T.StructField(into, T.BinaryType()),
            T.StructField("range_error", T.StringType()),
        ]
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                path = row.column("logical_path")[0].as_py()
                data, error = None, None
                try:
                    with open_input(path) as source:
                        source.seek(row.column("offset")[0].as_py())
                        data = source.read(row.column("size")[0].as_py())
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                columns = [
                    *row.columns,
                    pa.array([data], pa.large_binary() if data and len(data) > 2**30 else pa.binary()),
                    pa.array([error], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*row.schema.names, into, "range_error"])

    return ranges.mapInArrow(fetch, schema)


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Writes each ``content`` as the file ``logical_path`` below ``folder``, and gives (logical_path, length).

    A file appears under its name when it is whole, so an attempt that is lost or repeated leaves no part of one. The
    rows are the work: nothing is written before they are asked for. Paths that lead out of the folder are refused, null
    content makes an empty file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        store, root = open_store(folder)
        for batch in batches:
            paths, sizes = [], []
            for name, content in zip(batch.column("logical_path"), batch.column("content")):
                name, content = posixpath.normpath(name.as_py()), content.as_py() or b""
                if name.startswith(("/", "../")) or name in (".", ".."):
                    raise ValueError(f"{name} does not lie below the folder")
                place = f"{root.rstrip('/')}/{name}"
                above, base = posixpath.split(place)
                store.create_dir(above, recursive=True)
                with store.open_output_stream(f"{above}/_{base}.{attempt}") as out:
                    out.write(content)
                store.move(f"{above}/_{base}.{attempt}", place)
                paths.append(f"{folder.rstrip('/')}/{name}")
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["logical_path", "length"]
            )

    return files.select("logical_path", "content").mapInArrow(write, "logical_path string, length long")
