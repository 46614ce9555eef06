"""Packing: every id once, sequences full, costs balanced."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from adtally.llm import packing

FILE = public_tokenizers.path("byte_bpe_50k.json")
WORDS = ["alpha", "beta,", "gamma.", "Δelta", "don't", "  ", "\n", "42", "naïve", "😀", "<|endoftext|>"]


def pieces_of(spark, rows, parts=2, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, ids string").repartition(parts)
    return packing.pack(docs, FILE, **options).collect()


def checked(rows, pieces, length):
    tokenizer = Tokenizer.from_file(FILE)
    want = defaultdict(list)
    for doc_id, text, *_ in rows:
        want[doc_id].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    got = defaultdict(list)
    for p in sorted(pieces, key=lambda p: p.start):
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        got[p.doc_id].append((p.start, p.doc_tokens, ids))
    for doc_id, texts in want.items():
        if len(texts) == 1:
            joined, at = [], 0
            for start, total, ids in got[doc_id]:
                assert start == at and total == len(texts[0])
                joined += ids
                at += len(ids)
            assert joined == texts[0]
        assert sum(len(i) for *_, i in got[doc_id]) == sum(map(len, texts))
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    padding = 0
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert padding == 0
    return sequences


def test_every_id_once_and_no_padding(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(400))), 0, "x") for i in range(150)]
    rows += [(900, None, 0, None), (901, "", 1, ""), (902, "word " * 9000, 0, ""), (903, " " * 5000, 0, ""), rows[0], (None, "null id", 0, "")]
    for options in ({}, {"length": 64, "block": 8}, {"length": 256, "block": 2}):
        checked(rows, pieces_of(spark, rows, **options), options.get("length", 2048))


def test_costs_are_balanced():
    rng = random.Random(2)
    lengths = [rng.randrange(10, 600) for _ in range(2000)]
    while sum(lengths) < 2048 * 128:
        lengths.append(300)
    pieces = packing.pack_block(lengths, 2048, 128, 1.0, 1 / 1024)
    cost = defaultdict(float)
    for _, _, n, s, _ in pieces:
        cost[s] += n + n * n / 1024
    values = np.array(list(cost.values()))
    assert len(values) == 128
    # in order of arrival instead, fill each sequence before the next
    arrival, room, total = [0.0], 2048, 0
    for n in lengths:
        while n and total < 128 * 2048:
            take = min(n, room)
            arrival[-1] += take + take * take / 1024
            n, room, total = n - take, room - take, total + take
            if not room:
                arrival.append(0.0)
                room = 2048
    assert values.std() < np.array(arrival[:128]).std() / 2


def test_fast_encoder_agrees():
    encoder = packing.Encoder(FILE)
    rng = random.Random(3)
    texts = ["".join(rng.choice(WORDS + [" ", "\t", "\r\n", "　", "\x00", "'ll"]) for _ in range(30)) for _ in range(200)]
    texts += [chr(c) + " a" + chr(c) for c in range(0x20, 0x3000, 7) if not 0xD800 <= c < 0xE000]
    want = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(FILE).encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want


def test_empty_table(spark):
    assert pieces_of(spark, []) == []
