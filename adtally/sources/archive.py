"""Report archives: listing, choice of new reports, and the ZIP member reader.

Listing reads file metadata only (``binaryFile`` with ``content`` pruned), so the date
floor and the loaded-date anti join run before a single archive byte is read. Contents are
then loaded for the surviving archives alone and unpacked by a ``mapInArrow`` task per
input partition that streams member lines in bounded batches, or, on request, by one task
per member (``zip_members.py``).
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.functions.clean import base_name, report_date
from adtally.plans.kinds import ReportKind, get_kind

LINE_SCHEMA = "path string, member string, line_no long, line string"
BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
_BOM = "\ufeff"


def literal_path(path: str) -> str:
    """``path`` with the characters that Spark's readers take for a pattern escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _folder(spark: SparkSession, folder: str) -> str:
    """A folder of that very name if there is one, else the pattern that it may be."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return literal_path(folder) if path.getFileSystem(conf).exists(path) else folder


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """All ZIP files of ``folder`` (a name or a pattern): ``path, modificationTime, length``.

    File contents are never read here.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .load(_folder(spark, folder))
        .select("path", "modificationTime", "length")
    )


def list_archives(spark: SparkSession, folder: str, kind: str | ReportKind) -> DataFrame:
    """Archives of one kind in ``folder``: ``path, name, modificationTime, length, report_date``.

    ``report_date`` is null for a name that matches but carries no date; a load reports
    such archives as rejected.
    """
    return select_archives(archive_files(spark, folder), kind)


def select_archives(files: DataFrame, kind: str | ReportKind) -> DataFrame:
    """Keep files whose base name matches the kind's archive pattern; parse their date."""
    k = get_kind(kind)
    named = files.withColumn("name", base_name("path"))
    return named.filter(F.col("name").rlike(k.archive_regex)).withColumn("report_date", report_date("name"))


def choose_new(
    archives: DataFrame,
    loaded_dates: DataFrame | None,
    floor_date: str | None,
) -> DataFrame:
    """Archives still to load: on or after the floor, date not loaded, latest copy per date.

    ``loaded_dates`` has a string column ``date`` and may have a timestamp ``modified``, when
    the archive it was loaded from was modified: then a strictly newer archive of that date
    is chosen again. It is broadcast: it holds one row per calendar day, whatever the data
    volume. When two archives carry the same date (a re-download), the one modified last
    wins; ties go to the larger path. Archives without a date are never chosen.
    """
    out = archives.filter(F.col("report_date").isNotNull())
    if floor_date is not None:
        out = out.filter(F.col("report_date") >= F.lit(floor_date))
    if loaded_dates is not None:
        known = "modified" in loaded_dates.columns
        modified = F.col("modified") if known else F.lit(None).cast("timestamp")
        dates = loaded_dates.groupBy(F.col("date").cast("string").alias("_loaded")).agg(F.max(modified).alias("_modified"))
        same = F.col("report_date") == F.col("_loaded")
        if known:
            same &= F.col("_modified").isNull() | (F.col("modificationTime") <= F.col("_modified"))
        out = out.join(F.broadcast(dates), same, "left_anti")
    length = F.col("length") if "length" in out.columns else F.lit(None).cast("long")
    latest = F.max(F.struct("modificationTime", "path", length.alias("length"))).alias("_latest")
    return (
        out.groupBy("report_date")
        .agg(latest)
        .select(
            F.col("_latest.path").alias("path"),
            F.col("_latest.modificationTime").alias("modificationTime"),
            F.col("_latest.length").alias("length"),
            "report_date",
        )
    )


def matching_members(zf: zipfile.ZipFile, pattern: re.Pattern, first_only: bool, path: str) -> list[str]:
    """Member names matching ``pattern`` in code-point order (the first only, if asked).

    Raises, naming the archive, when no member matches.
    """
    names = sorted(n for n in zf.namelist() if not n.endswith("/") and pattern.search(n))
    if not names:
        raise ValueError(f"no report CSV matching {pattern.pattern!r} in archive {path}")
    return names[:1] if first_only else names


def member_line_batches(zf: zipfile.ZipFile, name: str, batch: int) -> Iterator[tuple[int, list[str]]]:
    r"""``(first line_no, lines)`` batches of one member, streamed while decompressing.

    Lines end at \n, \r\n or \r only (not at U+2028 and friends, which occur inside
    user-typed disclaimers); bytes that are not UTF-8 become U+FFFD; the BOM stays in the
    text. Blank lines before the first non-blank one are not counted.
    """
    with zf.open(name) as raw:
        text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline=None)
        buf: list[str] = []
        line_no = -1
        for line in text:
            if line.endswith("\n"):
                line = line[:-1]
            if line_no < 0:
                if line.replace(_BOM, "") == "":
                    continue
                line_no = 0
            buf.append(line)
            line_no += 1
            if len(buf) >= batch:
                yield line_no - len(buf), buf
                buf = []
        if buf:
            yield line_no - len(buf), buf


LINE_ARROW_SCHEMA = pa.schema(
    [("path", pa.string()), ("member", pa.string()), ("line_no", pa.int64()), ("line", pa.string())]
)


def line_batch(path: str, member: str, first_no: int, lines: list[str]) -> pa.RecordBatch:
    """One Arrow batch of member lines."""
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path] * n, pa.string()),
            pa.array([member] * n, pa.string()),
            pa.array(range(first_no, first_no + n), pa.int64()),
            pa.array(lines, pa.string()),
        ],
        schema=LINE_ARROW_SCHEMA,
    )


def rejected_batch(path: str, member: str | None, reason: str) -> pa.RecordBatch:
    """One line numbered -1 that says why an archive can't be read."""
    return line_batch(path, member, -1, [reason])


def tolerant_batches(path: str, member: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``, and in place of an error in the archive a line that names it."""
    try:
        yield from batches
    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, ValueError) as e:
        yield rejected_batch(path, member, f"{type(e).__name__}: {e}")


def _member_lines(
    path: str, content: bytes, pattern: re.Pattern, first_only: bool, batch: int
) -> Iterator[pa.RecordBatch]:
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        for name in matching_members(zf, pattern, first_only, path):
            for first_no, lines in member_line_batches(zf, name, batch):
                yield line_batch(path, name, first_no, lines)


def unzip_lines(
    archives: DataFrame,
    member_regex: str,
    first_member_only: bool = False,
    batch_lines: int = 10_000,
) -> DataFrame:
    """Lines of the matching members of each archive row (``path``, ``content``).

    Arrow batches in and out (``mapInArrow``), no pandas conversion. An archive that is
    damaged or holds no matching member gives a line numbered -1 with the reason.
    """
    from adtally.session import ship_package

    ship_package(archives.sparkSession)
    pattern = re.compile(member_regex)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = b.column("path").to_pylist()
            contents = b.column("content")
            for i, path in enumerate(paths):
                content = contents[i].as_py()
                lines = _member_lines(path, content, pattern, first_member_only, batch_lines)
                yield from tolerant_batches(path, None, lines)

    return archives.select("path", "content").mapInArrow(unpack, LINE_SCHEMA)


READERS = ("archive", "members")


def read_archive_lines(
    spark: SparkSession,
    paths: list[str],
    kind: str | ReportKind,
    reader: str = "archive",
    member_regex: str | None = None,
) -> DataFrame:
    """Load the given archives and return their member lines for ``kind``.

    ``paths`` are the few archives chosen by :func:`choose_new` (file names, not data).
    ``reader="archive"``: ``binaryFile`` + ``mapInArrow``, one task per archive (any
    Hadoop file system; an archive must stay below 2 GB). ``reader="members"``: one task
    per (archive, member) reading only that member's bytes (file systems reachable through
    pyarrow). Either way an archive member is decompressed by one task; ``spread_lines``
    afterwards spreads the parsing. Archives that can't be read give lines numbered -1.
    """
    k = get_kind(kind)
    pattern = member_regex or k.member_regex
    if reader not in READERS:
        raise ValueError(f"reader must be one of {READERS}")
    if reader == "members":
        from adtally.sources.zip_members import read_members

        return read_members(spark, paths, pattern, k.first_member_only)
    content = spark.read.format("binaryFile").load([literal_path(p) for p in paths])
    return unzip_lines(content, pattern, k.first_member_only)
