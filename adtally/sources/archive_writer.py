"""Write report archives from a lines DataFrame (for replays, exports and test inputs).

Rows ``archive, member, line_no, line`` are range-partitioned in the order of the archives'
text, so the lines of a large member are dealt over many tasks. Each task deflates its lines
into pieces that end at a byte; deflated pieces put one after the other are one deflate
stream. A second step deals the pieces out by archive and appends them to ZIP files through
pyarrow's filesystem layer (local paths, HDFS or object stores alike), so the one task that
an archive needs reads its packed bytes only. Nothing is gathered in memory. Each archive is
written under a hidden name of its own task attempt and moved into place when complete, so a
retried or speculative task never exposes a half-written archive to a listing.
"""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.sources.zip_members import filesystem_of

HeaderOf = Callable[[str], str | None]
WRITTEN_SCHEMA = "archive string, members long, lines long"


def _attempt_tag() -> str:
    from pyspark import TaskContext

    ctx = TaskContext.get()
    return f"{ctx.taskAttemptId()}" if ctx is not None else "driver"


# Text (names included, as each row holds them) that one task is to deflate, and that one
# piece holds.
PART_BYTES = 128 * 1024 * 1024
PIECE_BYTES = 1024 * 1024
_PIECE_SCHEMA = "archive string, member string, part int, seq long, lines long, size long, crc long, data binary"
_PIECE_ARROW_SCHEMA = pa.schema(
    [("archive", pa.string()), ("member", pa.string()), ("part", pa.int32()), ("seq", pa.int64())]
    + [("lines", pa.int64()), ("size", pa.int64()), ("crc", pa.int64()), ("data", pa.binary())]
)
_WRITTEN_ARROW_SCHEMA = pa.schema([("archive", pa.string()), ("members", pa.int64()), ("lines", pa.int64())])
# an empty last block: ends a deflate stream
_END = b"\x03\x00"


def deflated(text: bytes) -> bytes:
    """``text`` as deflate blocks up to a byte's end, none of them the stream's last."""
    packer = zlib.compressobj(zlib.Z_DEFAULT_COMPRESSION, zlib.DEFLATED, -zlib.MAX_WBITS)
    return packer.compress(text) + packer.flush(zlib.Z_FULL_FLUSH)


def _crc_of_zeros(size: int, crc: int = 0) -> int:
    zeros = bytes(min(size, PIECE_BYTES))
    while size > 0:
        crc = zlib.crc32(zeros if size >= len(zeros) else zeros[:size], crc)
        size -= len(zeros)
    return crc


_crc_of_only_zeros = lru_cache(maxsize=1024)(_crc_of_zeros)


def joined_crc(first: int, second: int, size: int) -> int:
    """The CRC-32 of two texts one after the other, from theirs and the second's ``size``."""
    return _crc_of_zeros(size, first) ^ _crc_of_only_zeros(size) ^ second


def _line_runs(batches: Iterator[pa.RecordBatch], piece_bytes: int) -> Iterator[tuple[str, str, list[str]]]:
    """``(archive, member, lines)`` of lines one after the other, about ``piece_bytes`` each."""
    key, lines, size = (None, None), [], 0
    for b in batches:
        for archive, member, line in zip(*(b.column(c).to_pylist() for c in ("archive", "member", "line"))):
            if lines and (size >= piece_bytes or archive != key[0] or member != key[1]):
                yield *key, lines
                lines, size = [], 0
            if not lines:
                key = (archive, member)
            lines.append(line)
            size += len(line) + 1
    if lines:
        yield *key, lines


class _ArchiveStream:
    def __init__(self, uri: str, header_of: HeaderOf | None):
        self.uri = uri
        self.fs, self.path = filesystem_of(uri)
        parent, name = self.path.rsplit("/", 1)
        self.fs.create_dir(parent, recursive=True)
        # hidden to Spark's file listing (leading dot) and to the *.zip glob
        self.tmp = f"{parent}/.{name}.{_attempt_tag()}.tmp"
        self.out = self.fs.open_output_stream(self.tmp)
        self.zf = zipfile.ZipFile(self.out, "w", compression=zipfile.ZIP_DEFLATED)
        self.header_of = header_of
        self.info: zipfile.ZipInfo | None = None
        self.members = 0
        self.lines = 0

    def write(self, member: str, lines: int, size: int, crc: int, data: bytes) -> None:
        """Append a deflated piece to ``member`` (members arrive one after the other)."""
        if self.info is None or member != self.member:
            self._close_member()
            self._open_member(member)
            header = self.header_of(member) if self.header_of else None
            if header is not None:
                text = f"{header}\n".encode("utf-8")
                self._append(len(text), zlib.crc32(text), deflated(text))
        self._append(size, crc, data)
        self.lines += lines

    def _open_member(self, member: str) -> None:
        # zipfile takes no deflated bytes, so the member's local header, its descriptor and
        # its place in the directory are put in here; sizes and CRC follow the data
        self.member = member
        self.info = zipfile.ZipInfo(member)
        self.info.compress_type = zipfile.ZIP_DEFLATED
        self.info.external_attr = 0o600 << 16
        self.info.flag_bits = 0x08
        self.info.header_offset = self.zf.fp.tell()
        self.info.CRC = self.info.compress_size = self.info.file_size = 0
        self.zf.fp.write(self.info.FileHeader(zip64=True))
        self.members += 1

    def _append(self, size: int, crc: int, data: bytes) -> None:
        self.zf.fp.write(data)
        self.info.CRC = joined_crc(self.info.CRC, crc, size)
        self.info.file_size += size
        self.info.compress_size += len(data)

    def _close_member(self) -> None:
        if self.info is None:
            return
        self._append(0, 0, _END)
        i = self.info
        self.zf.fp.write(struct.pack("<LLQQ", 0x08074B50, i.CRC, i.compress_size, i.file_size))
        self.zf.start_dir = self.zf.fp.tell()
        self.zf.filelist.append(i)
        self.zf.NameToInfo[i.filename] = i
        self.info = None

    def close(self, extra: dict[str, str]) -> tuple[str, int, int]:
        self._close_member()
        for name, text in extra.items():
            self.zf.writestr(name, text)
        self.zf.close()
        self.out.close()
        self.fs.move(self.tmp, self.path)
        return self.uri, self.members, self.lines


def _parts(lines: DataFrame) -> int:
    """Tasks for ``lines``: one for each core, or for each ``PART_BYTES`` of text if these are more."""
    text = F.octet_length(F.concat_ws("", "archive", "member", "line"))
    size = lines.agg(F.sum(text.cast("long"))).first()[0] or 0
    return max(lines.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))


def write_archives(
    lines: DataFrame, folder: str, partitions: int | None = None, header_of: HeaderOf | None = None,
    extra: dict[str, str] | None = None,
) -> DataFrame:
    """Write one ZIP per distinct ``archive`` (a file name) under ``folder``.

    ``header_of`` gives a member's first line (None: no header), so that the lines need not
    be read a second time to find the members; ``extra`` members (name and text) go into
    every archive, uncounted. The lines are deflated in ``partitions`` tasks, whatever
    archives and members they belong to; by default their bytes are summed first, at once,
    and a task gets about ``PART_BYTES``. An archive is one file, so one task appends its
    deflated pieces; many archives are written side by side.

    Returns one row per archive written: ``archive`` (full URI), ``members``, ``lines``.
    An action on the result performs the writes.
    """
    from adtally.session import ship_package

    ship_package(lines.sparkSession)
    base = folder.rstrip("/")
    more = dict(extra or {})
    wanted = lines.select("archive", "member", "line_no", "line")
    width, piece_bytes = partitions or _parts(wanted), PIECE_BYTES
    # numbers of range partitions go up with the order of their lines
    order = ("archive", "member", "line_no")
    ordered = wanted.repartitionByRange(width, *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for seq, (archive, member, run) in enumerate(_line_runs(batches, piece_bytes)):
            text = ("\n".join(run) + "\n").encode("utf-8")
            row = (archive, member, part, seq, len(run), len(text), zlib.crc32(text), deflated(text))
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _PIECE_ARROW_SCHEMA)], schema=_PIECE_ARROW_SCHEMA)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _ArchiveStream | None = None
        done = []
        for b in batches:
            names = ("archive", "member", "lines", "size", "crc")
            for i, (archive, *piece) in enumerate(zip(*(b.column(c).to_pylist() for c in names))):
                uri = f"{base}/{archive}"
                if current is None or current.uri != uri:
                    if current is not None:
                        done.append(current.close(more))
                    current = _ArchiveStream(uri, header_of)
                current.write(*piece, b.column("data")[i].as_py())
        if current is not None:
            done.append(current.close(more))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(_WRITTEN_ARROW_SCHEMA.names, d)) for d in done], schema=_WRITTEN_ARROW_SCHEMA
        )

    pieces = ordered.mapInArrow(pack, _PIECE_SCHEMA).repartition(width, "archive")
    in_order = pieces.sortWithinPartitions("archive", "member", "part", "seq")
    return in_order.mapInArrow(write, WRITTEN_SCHEMA).filter(F.col("archive").isNotNull())
