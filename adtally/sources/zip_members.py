"""Member lines of archives, one task per (archive, member).

A first distributed step opens each archive's central directory (names only) and gives one
row per member; the rows are dealt out one by one, and each task decompresses just its
members, so the members of one archive are read in parallel and no archive is held in
memory. Archives are opened through pyarrow's file systems, in tasks only.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.sources.archive import LINE_SCHEMA, line_batch, matching_members, member_line_batches, tolerant_batches

_MEMBER_SCHEMA = "path string, member string, problem string"


def filesystem_of(uri: str):
    """pyarrow's file system and the path in it. Local paths may hold any character; s3a is
    pyarrow's s3."""
    from pyarrow import fs

    if uri.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", uri))


def open_archive(uri: str):
    """A seekable file."""
    filesystem, path = filesystem_of(uri)
    return filesystem.open_input_file(path)


def read_members(
    spark: SparkSession,
    paths: list[str],
    member_regex: str,
    first_member_only: bool = False,
    batch_lines: int = 10_000,
    partitions: int | None = None,
) -> DataFrame:
    """Member lines of the given archives, dealt out over ``partitions`` (default: two for
    each core). An archive that can't be opened or has no matching member gives a line
    numbered -1 with the reason."""
    from adtally.session import ship_package

    ship_package(spark)
    pattern = re.compile(member_regex)

    def members(path: str) -> Iterator[pa.RecordBatch]:
        with open_archive(path) as f, zipfile.ZipFile(f) as zf:
            names = matching_members(zf, pattern, first_member_only, path)
        yield line_batch(path, None, 0, names)

    def list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                for found in tolerant_batches(path, None, members(path)):
                    good = found.column(2)[0].as_py() >= 0
                    texts, none = found.column(3), pa.nulls(found.num_rows, pa.string())
                    columns = [found.column(0), texts if good else none, none if good else texts]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "member", "problem"])

    def lines_of(path: str, name: str) -> Iterator[pa.RecordBatch]:
        with open_archive(path) as f, zipfile.ZipFile(f) as zf:
            for first_no, lines in member_line_batches(zf, name, batch_lines):
                yield line_batch(path, name, first_no, lines)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, name, problem in zip(*(c.to_pylist() for c in b.columns)):
                if problem is not None:
                    yield line_batch(path, None, -1, [problem])
                else:
                    yield from tolerant_batches(path, name, lines_of(path, name))

    cores = spark.sparkContext.defaultParallelism
    width = partitions or 2 * cores
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(max(len(paths), 1), width))
    dealt = listed.mapInArrow(list_members, _MEMBER_SCHEMA).repartition(width, F.xxhash64("path", "member"))
    return dealt.mapInArrow(read, LINE_SCHEMA)
