"""Importance resampling against a plain version, and the table of n-grams on its own."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from adtally.llm import resampling
from adtally.llm.words import lowered, pieces

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams_of(text, n=1):
    w = words_of(text)
    return [" ".join(w[i : i + k]).encode() for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, n=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    """(id, n_features, weight, score, rank) of each document, written without any batch."""
    count = lambda texts: Counter(zlib.crc32(g) % buckets for t in texts for g in grams_of(t, n))
    s, t = count(x for _, x in docs), count(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for i, text in docs:
        found = [gain(zlib.crc32(g) % buckets) for g in grams_of(text, n)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(words_of(text))])
    fit = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(spark, docs, target, **more):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    args = {"max_n": more.get("n", 1), **{k: v for k, v in more.items() if k != "n"}}
    out = resampling.resample(frame, goal, **args)
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()), key=str)


TEXTS = [
    "The cat sat on the mat, and the dog ran off with 3 hats " * 3,
    "Ñandú über straße 東京 " * 8,
    None, "", "   \n\t", "one", "x" * 100 + " " + "y" * 33 + " short " + "z" * 32,
]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_against_plain_version(spark, n):
    docs = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)] + [(None, TEXTS[0]), (7, TEXTS[0]), (7, TEXTS[0])]
    target = ["the cat ran on and on " * 4, None, "東京 東京"]
    for percent in (10, 100):
        assert found(spark, docs, target, n=n, percent=percent, min_words=3) == brute(docs, target, n, percent=percent, min_words=3)


def test_ranks_are_gapless_when_one_row_is_repeated(spark):
    docs = [(1, TEXTS[0])] * 40 + [(i, TEXTS[1]) for i in range(2, 60)]
    out = found(spark, docs, ["cat"], percent=60)
    ranks = sorted(r[4] for r in out if r[4] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and len(out) == 98
    assert out == brute(docs, ["cat"], percent=60)


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, TEXTS[0], 5, "x", 2)], "doc_id long, text string, score long, bucket string, rank long")
    assert resampling.resample(none, some).count() == 0
    row = resampling.resample(some, none, percent=100).first()
    assert (row.doc_id, row.n_features, row["rank"]) == (1, 42, 1)


def test_long_text_is_cut_between_words_only(spark):
    text = " ".join(f"w{i % 977}" for i in range(400_000)) + " " + "v" * 3_000_000 + " end"
    docs = [(1, text), (2, "w1 w2 w3 " * 10)]
    assert found(spark, docs, ["w1 w2"], n=2, percent=50) == brute(docs, ["w1 w2"], 2, percent=50)


@pytest.mark.parametrize("overlap", [0, 1, 2])
def test_pieces_hold_each_run_once(overlap):
    text = lowered("alpha beta, gamma  delta epsilon zeta " * 40)
    runs = Counter()
    for part, own in pieces(text, overlap, size=37):
        for m in re.finditer(rb"[^ ]+", part):
            if m.start() < own:
                runs[tuple(part[m.start() :].split()[: overlap + 1])] += 1
    w = text.split()
    assert runs == Counter(tuple(w[i : i + overlap + 1]) for i in range(len(w)))


def _stretches(keys):
    data = np.frombuffer(b"".join(keys) + b"\0" * 16, np.uint8)
    lengths = np.array([len(k) for k in keys])
    return data, np.cumsum(lengths) - lengths, lengths


def test_hashes_are_those_of_the_library():
    rng = np.random.default_rng(1)
    keys = [rng.bytes(n) for n in range(80)] * 2
    data, starts, lengths = _stretches(keys)
    assert resampling.xxh64(data, starts, lengths).tolist() == [xxhash.xxh64_intdigest(k) for k in keys]


@pytest.mark.parametrize("bits", [0, 1, 64])
def test_equal_hashes_of_different_grams_are_told_apart_by_their_bytes(bits):
    keys = [b"ab", b"ab", b"abc", b"abcdefgh", b"abcdefghi", b"abcdefghj", b"abcdefgh", b"", b"q" * 40, b"q" * 39 + b"r"] * 3
    data, starts, lengths = _stretches(keys)
    few = lambda *a: resampling.xxh64(*a) & np.uint64((1 << bits) - 1)
    table = resampling.GramTable(data, starts, lengths, few)
    slots = {}
    for k, slot in zip(keys, table.slot_of.tolist(), strict=True):
        assert slots.setdefault(k, slot) == slot
    assert len(set(slots.values())) == len(slots)
    counts = Counter(keys)
    for k, slot in slots.items():
        assert table.count[slot] == counts[k] and table.buckets(97)[slot] == zlib.crc32(k) % 97
