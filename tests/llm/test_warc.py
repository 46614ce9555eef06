"""WARC archives: round trip, revisits, dictionary frame, odd pages."""

import base64
import hashlib
import io
import random
import struct

import pytest
import zstandard

from adtally.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, sha1 int"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def brute(rows, least=0):
    largest = {}
    for i, _, h, *_ in rows:
        data = (h or "").encode()
        if len(data) >= least and i is not None:
            largest[data] = max(largest.get(data, i), i)
    out = []
    for i, url, h, *_ in rows:
        data = (h or "").encode()
        kept = largest.get(data) if len(data) >= least else None
        revisit = kept is not None and kept != i
        out.append((i, len(data), digest(data), "revisit" if revisit else "response", kept if revisit else None, None if revisit else data))
    return sorted(out, key=repr)


def pages(rng, n=80):
    words = ["<p>", "Grüße", "page", "the", "</p>", "\r\n\r\n", "WARC/1.1\r\n"]
    rows = []
    for i in range(n):
        html = " ".join(rng.choice(words) for _ in range(rng.randrange(400)))
        rows.append((i, f"https://e.example/{i}", rows[rng.randrange(len(rows))][2] if rows and rng.random() < 0.4 else html, "clash", 1))
    rows += [(100, None, None, "", 1), (101, "", "", "", 1), (102, "a\r\nX: y z\n", "x", "", 1), (None, "u", "x", "", 1), (None, "u", "only", "", 1)]
    rows += [(102, "again", "x", "", 1), (103, "u", "long " * 300_000, None, None), (104, "ü?q=😀", "\0\r\n", "", 1)]
    return rows


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, tmp_path, least):
    rows = pages(random.Random(1))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    listed = warc.write(docs, str(tmp_path / "a b"), least=least, archive_bytes=50_000).collect()
    assert sum(r.records for r in listed) == len(rows) and len(listed) > 2
    assert not [p for p in (tmp_path / "a b").iterdir() if p.name.startswith(".") and "attempt" in p.name and not p.name.endswith(".crc")]
    found = warc.read(spark, str(tmp_path / "a b")).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in found]
    assert sorted(got, key=repr) == brute(rows, least)
    urls = {r.page_id: r.url for r in found}
    assert urls[100] is None and urls[5] == "https://e.example/5" and urls[104] == "ü?q=😀" and "\n" not in urls[102]
    assert "payload" not in warc.read(spark, str(tmp_path / "a b"), payloads=False).columns


def test_dictionary_leads_and_records_stand_alone():
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta"] + [f"<div class='c{k}'>" for k in range(40)]
    texts = [" ".join(rng.choice(words) for _ in range(60)).encode() for _ in range(400)]
    records = [warc.record(i, None, t, digest(t), None) for i, t in enumerate(texts)]
    out = io.BytesIO()
    warc.pack(records, out)
    data = out.getvalue()
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.DICTIONARY_MAGIC
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    assert dictionary.dict_id()
    # each record is a frame of its own
    rest, count = data[8 + size :], 0
    while rest:
        unpacker = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        assert unpacker.decompress(rest) == records[count]
        rest, count = unpacker.unused_data, count + 1
    assert count == len(records)
    assert len(data) < sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert [r["payload"] for r in warc.parse(warc.unpack(data))] == texts


@pytest.mark.parametrize("texts", [[b""], [b"x"], [b"page"] * 3, [b"one", b"other " * 9000], [b"same " * 400] * 20])
def test_small_archives_have_a_dictionary_too(texts):
    out = io.BytesIO()
    warc.pack([warc.record(i, None, t, digest(t), None) for i, t in enumerate(texts)], out)
    assert struct.unpack_from("<I", out.getvalue())[0] == warc.DICTIONARY_MAGIC
    assert [r["payload"] for r in warc.parse(warc.unpack(out.getvalue()))] == texts


def test_dictionary_learns_from_all_of_the_archive(monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 64 << 10)
    monkeypatch.setattr(warc, "PIECE_BYTES", 1 << 10)
    rng = random.Random(3)
    early = [rng.randbytes(1000) for _ in range(300)]
    late = [b"<section class='late-%d'>" % (k % 7) + b"a passage that only later pages share " * 4 for k in range(700)]
    assert b"later pages share" in warc.dictionary_of(early + late).as_bytes()


def test_what_other_attempts_left_is_not_read(spark, tmp_path):
    rows = pages(random.Random(4))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    folder = str(tmp_path / "twice")
    warc.write(docs, folder).collect()  # an attempt whose list was never committed
    warc.write(docs, folder, archive_bytes=9000).write.parquet(str(tmp_path / "list"))
    found = warc.read(spark, spark.read.parquet(str(tmp_path / "list"))).collect()
    assert sorted((r.page_id is None, r.page_id or 0) for r in found) == sorted((i is None, i or 0) for i, *_ in rows)
    assert warc.read(spark, folder).count() == 2 * len(rows)
    assert warc.read(spark, spark.createDataFrame([], "archive string, records long")).collect() == []


def test_damage_is_an_error():
    good = warc.record(1, "u", b"payload", digest(b"payload"), None)
    out = io.BytesIO()
    warc.pack([good.replace(b"payload\r\n", b"PAYLOAD\r\n")], out)
    with pytest.raises(ValueError, match="isn't what|is not what"):
        list(warc.parse(warc.unpack(out.getvalue())))


def test_empty_table(spark, tmp_path):
    assert warc.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "none")).collect() == []
