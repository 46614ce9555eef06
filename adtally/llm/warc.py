"""WARC archives, each record one Zstandard frame, with a dictionary made for the archive.

Layout of a ``.warc.zst``: a skippable frame (magic 0x184D2A5D) with the dictionary, itself
a Zstandard frame; then one frame for each record, compressed with that dictionary. Any
record can be unpacked knowing only the dictionary and its place.

Equal payloads are stored once: the record with the largest id is the response, the others
are revisit records that name it. The choice is a grouped maximum of the digest; the rows
meet it in a join that Spark splits where one payload is very common. Each task then writes
its rows as archives of bounded size, under an attempt's own name until they are complete.

Before writing the first record of an archive, the task trains the dictionary on pieces
from all over that archive (about ``SAMPLE_BYTES`` of them). Of an archive too small to
train on, these pieces themselves are the dictionary.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm.shared import python_ready
from adtally.session import shared_dir

DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
#: A dictionary is trained on about so many bytes of an archive, in pieces.
SAMPLE_BYTES = 4 << 20
PIECE_BYTES = 16 << 10
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
#: Payloads of fewer bytes are always responses.
LEAST_SHARED = 0

_PAGE = "urn:page:"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


# --- one record --------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without the payload if ``refers_to`` is given."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    # control characters and blanks would break the header's lines
    uri = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_PAGE}{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        *([f"WARC-Target-URI: {uri}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{_PAGE}{refers_to}>",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "surrogatepass").partition(": ") for line in lines)
    return {k.lower(): v for k, _, v in pairs}


def parse(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of an unpacked archive, one at a time; digests of responses are verified."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not the beginning of a WARC record: {line[:40]!r}")
        lines = []
        while (line := stream.readline()) != b"\r\n":
            if not line:
                raise ValueError("a WARC record ends within its header")
            lines.append(line[:-2])
        head = _fields(lines)
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record is cut short")
        http, _, payload = block.partition(b"\r\n\r\n")
        claimed = int(_fields(http.split(b"\r\n")[1:])["content-length"])
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        kind = head["warc-type"]
        if kind == "response" and (len(payload) != claimed or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"the payload of {head['warc-record-id']} is not what its header says")
        page = lambda name: int(v) if (v := head.get(name, "")[len(_PAGE) + 1 : -1]) else None
        yield {
            "page_id": page("warc-record-id"), "url": head.get("warc-target-uri"), "payload_bytes": claimed, "payload_digest": digest,
            "record_type": kind, "refers_to": page("warc-refers-to"), "payload": payload if kind == "response" else None,
        }


# --- one archive -------------------------------------------------------------------------


def dictionary_of(records: list[bytes]):
    """A dictionary trained on pieces from all over the archive.

    Where training finds too little, the pieces themselves are the dictionary.
    """
    import zstandard

    parts = [r[at : at + PIECE_BYTES] for r in records for at in range(0, len(r), PIECE_BYTES)]
    sample = parts[:: -(-sum(map(len, parts)) // SAMPLE_BYTES)]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, sample)) // 8), sample)
    except zstandard.ZstdError:
        content = b"".join(sample)[:DICTIONARY_BYTES]
        return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def pack(records: list[bytes], out: io.BufferedIOBase, level: int = LEVEL) -> None:
    """The dictionary frame and one frame for each record."""
    import zstandard

    dictionary = dictionary_of(records)
    frame = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(frame)) + frame)
    dictionary.precompute_compress(level=level)
    # with sizes and checksums in the frames, and without the dictionary's number checked twice
    packer = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
    for r in records:
        out.write(packer.compress(r))


def unpack(data: bytes) -> io.BufferedReader:
    """The records of an archive as one stream, unpacked while it is read."""
    import zstandard

    dictionary, start = None, 0
    if len(data) >= 8:
        magic, size = struct.unpack_from("<II", data)
        if magic == DICTIONARY_MAGIC:
            start = 8 + size
            dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:start]))
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(memoryview(data)[start:], read_across_frames=True)
    return io.BufferedReader(reader, 1 << 18)


def _filesystem(uri: str):
    """pyarrow's file system of a folder, and the path in it; local paths may hold anything."""
    from pyarrow import fs

    if uri.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _content(uri: str) -> pa.Buffer:
    files, path = _filesystem(uri)
    with files.open_input_file(path) as stored:
        return stored.read_buffer()


def _save(folder: str, name: str, records: list[bytes]) -> str:
    files, path = _filesystem(folder)
    files.create_dir(path, recursive=True)
    # the name's ending isn't to be taken for a wish to compress the stream
    with files.open_output_stream(f"{path}/.{name}", compression=None) as out:
        pack(records, out)
    files.move(f"{path}/.{name}", f"{path}/{name}")
    return f"{folder}/{name}"


# --- operator ----------------------------------------------------------------------------


def with_responses(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``page_id, url, payload, sha1 (hex), refers_to`` (null for responses)."""
    rows = pages.withColumn("payload", F.encode(F.coalesce("html", F.lit("")), "UTF-8")).select(
        "page_id", "url", "payload", F.sha1("payload").alias("sha1")
    )
    first = rows.filter(F.octet_length("payload") >= least).groupBy("sha1").agg(F.max("page_id").alias("kept"))
    return rows.join(first, "sha1", "left").select(
        "page_id", "url", "payload", "sha1",
        F.when((F.octet_length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept")).alias("refers_to"),
    )


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least: int = LEAST_SHARED, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes ``.warc.zst`` archives; one row per archive, ``archive, records``, when acted on.

    A null html is an empty payload, a null url has no target line. Equal payloads whose ids
    are all null are all responses; a null id beside others revisits. Rows that repeat the
    largest id are responses each. Other columns are ignored. No row, no archive.

    Archives bear their task attempt's name, so a repeated or second attempt replaces none;
    what it leaves is in no list. Write the result and hand it to ``read``.
    """
    python_ready(pages)
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        held, size, count = [], 0, 0

        def save() -> pa.RecordBatch:
            name = f"part-{task.partitionId():05d}-{count:04d}-attempt-{task.taskAttemptId()}.warc.zst"
            uri = _save(folder, name, held)
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(held)], pa.int64())], ["archive", "records"])

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                columns = (c.to_pylist() for c in batch.slice(start, 256).columns)
                for page_id, url, payload, sha1, refers_to in zip(*columns):
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    held.append(record(page_id, url, payload, digest, refers_to))
                    size += len(held[-1])
                    if size >= archive_bytes:
                        yield save()
                        held, size, count = [], 0, count + 1
        if held:
            yield save()

    return with_responses(rows, least).mapInArrow(run, "archive string, records bigint")


def read(spark: SparkSession, archives: DataFrame | str, payloads: bool = True) -> DataFrame:
    """One row per record of archives: ids, url, digest, type, payload.

    ``archives`` is the written list that ``write`` gave (column ``archive``), or a folder of
    which every archive is read, whoever left it there.

    ``payload_bytes`` and ``payload_digest`` are of the full payload, also for revisits,
    whose ``payload`` is null; without ``payloads`` the column is left out.
    """
    fields = {
        "page_id": "bigint", "url": "string", "payload_bytes": "bigint", "payload_digest": "string",
        "record_type": "string", "refers_to": "bigint", **({"payload": "binary"} if payloads else {}),
    }
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[f] for r in found], kinds[k]) for f, k in fields.items()], list(fields))

        for batch in batches:
            for stored in batch.column(0):
                data = _content(stored.as_py()) if listed else stored.as_buffer()
                found, size = [], 0
                for r in parse(unpack(data)):
                    found.append(r)
                    size += len(r["payload"] or b"") if payloads else 100
                    if size >= 8 << 20:
                        yield out(found)
                        found, size = [], 0
                if found:
                    yield out(found)

    python_ready(spark.range(0))
    listed = isinstance(archives, DataFrame)
    if listed:
        tasks = min(archives.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
        stored = archives.select("archive").repartition(max(tasks, 1))
    else:
        stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(archives).select("content")
    return stored.mapInArrow(run, ", ".join(f"{f} {k}" for f, k in fields.items()))


def new_folder(spark: SparkSession) -> str:
    """A folder of its own for a run's archives, in the shared folder."""
    return f"{shared_dir(spark, 'llm')}/warc-{uuid.uuid4().hex}"
