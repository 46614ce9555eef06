import re
import zipfile
import zlib

from pyspark.sql import functions as F

from adtally.sources import archive_writer
from adtally.sources.archive_writer import deflated, joined_crc, write_archives


def test_a_large_member_is_dealt_over_many_tasks(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(archive_writer, "PART_BYTES", 20_000, raising=False)
    monkeypatch.setattr(archive_writer, "PIECE_BYTES", 700, raising=False)
    n = 6000
    lines = spark.range(n, numPartitions=3).select(
        F.when(F.col("id") % 100 == 0, "small.zip").otherwise("large.zip").alias("archive"),
        F.when(F.col("id") % 3 == 0, "regions/ä.csv").otherwise("b.csv").alias("member"),
        (n - F.col("id")).alias("line_no"),
        F.concat(F.lit("zeile “"), F.col("id"), F.lit("”")).alias("line"),
    )
    written = write_archives(lines, f"{tmp_path}/out", header_of=lambda m: "kopf" if m == "b.csv" else None, extra={"notes.txt": "n"})
    written.explain()
    plan = capsys.readouterr().out
    parts = [int(x) for x in re.findall(r"rangepartitioning\([^)]*, (\d+)\)", plan)]
    text = 6000 * len("large.zipb.csvzeile 1000")
    assert parts and min(parts) >= text // 20_000

    wanted = {}
    for i in reversed(range(n)):
        at = ("small.zip" if i % 100 == 0 else "large.zip", "regions/ä.csv" if i % 3 == 0 else "b.csv")
        wanted.setdefault(at, []).append(f"zeile “{i}”")
    rows = {r.archive.rsplit("/", 1)[1]: (r.members, r.lines) for r in written.collect()}
    assert rows == {"large.zip": (2, 5940), "small.zip": (2, 60)}
    for archive in rows:
        with zipfile.ZipFile(f"{tmp_path}/out/{archive}") as zf:
            assert zf.testzip() is None
            assert zf.namelist() == ["b.csv", "regions/ä.csv", "notes.txt"]
            assert zf.read("b.csv").decode() == "\n".join(["kopf", *wanted[archive, "b.csv"]]) + "\n"
            assert zf.read("regions/ä.csv").decode() == "\n".join(wanted[archive, "regions/ä.csv"]) + "\n"
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")) == ["large.zip", "small.zip"]


def test_pieces_join_to_one_stream():
    texts = [b"", b"one\n", b"two\n" * 1000, bytes(range(256)) * 9000]
    crc, packed = 0, b""
    for t in texts:
        crc, packed = joined_crc(crc, zlib.crc32(t), len(t)), packed + deflated(t)
    whole = b"".join(texts)
    assert crc == zlib.crc32(whole)
    assert zlib.decompress(packed + b"\x03\x00", -zlib.MAX_WBITS) == whole


def test_no_lines_no_archives(spark, tmp_path):
    none = spark.createDataFrame([], "archive string, member string, line_no long, line string")
    assert write_archives(none, f"{tmp_path}/none").collect() == []
