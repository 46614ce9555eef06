"""Removal of 200-byte repeats against brute force, and the parts of the merge sort."""

import random

import numpy as np

from adtally.llm import repeats

SCHEMA = "doc_id long, text string, k1 int, kept string"


def brute(texts):
    seen, again = set(), set()
    data = [(t or "").encode() for t in texts]
    for t in data:
        for i in range(len(t) - 199):
            (again if t[i : i + 200] in seen else seen).add(t[i : i + 200])
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if t[i : i + 200] in again:
                gone[i : i + 200] = b"\1" * 200
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def prose(rng, n):
    return "".join(rng.choice("abcdeé \n") for _ in range(n))


def compared(spark, texts, parts=5):
    rows = [(i, t, 0, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(docs).collect()}
    for i, want in enumerate(brute(texts)):
        assert found[i] == want, i
    assert len(found) == len(texts)


def test_copies_passages_and_edits(spark):
    rng = random.Random(1)
    shared = [prose(rng, n) for n in (199, 200, 201, 260, 420, 900)]
    texts = []
    for i in range(60):
        text = prose(rng, rng.randrange(0, 900))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(shared) + text[at:]
        texts.append(text)
        if rng.random() < 0.4:  # a near copy
            old = list(rng.choice(texts))
            for _ in range(rng.randrange(4)):
                if old:
                    old[rng.randrange(len(old))] = rng.choice("xyz")
            texts.append("".join(old))
    # within one text, periodic, short, empty, null, copies, all one byte
    texts += [shared[4] + "|" + shared[4], "abc" * 200, "a" * 201, "a" * 200, "", None, texts[0], texts[0], prose(rng, 5000) * 2]
    compared(spark, texts)


def test_large_groups_are_settled_by_aggregation(spark, monkeypatch):
    rng = random.Random(2)
    passage = prose(rng, 300)
    monkeypatch.setattr(repeats, "LARGE", 3)
    compared(spark, [prose(rng, rng.randrange(50, 400)) + passage + prose(rng, 300) for _ in range(60)])


def test_long_texts_are_cut_into_pieces(spark):
    rng = random.Random(3)
    passage = prose(rng, 700)
    start = repeats.PIECE - 300
    text = "".join(chr(97 + b % 26) for b in rng.randbytes(start)) + passage
    text += "".join(chr(97 + b % 26) for b in rng.randbytes(1000))
    compared(spark, [text, prose(rng, 100) + passage])


def test_repeated_ids_and_null_ids(spark):
    rng = random.Random(4)
    a, b = prose(rng, 500), prose(rng, 500)
    rows = [(1, a, 0, ""), (1, b, 0, ""), (1, a, 0, ""), (None, b, 0, ""), (None, prose(rng, 300), 0, ""), (2, prose(rng, 300), 0, "")]
    found = repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in found) == sorted(
        [(1, len(a.encode())), (1, len(b.encode())), (1, len(a.encode())), (0, len(b.encode())), (0, 0), (2, 0)]
    )


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_front_coding_round_trip():
    rng = np.random.default_rng(5)
    strings = rng.integers(0, 2, (500, repeats.WIDTH), dtype=np.uint8)
    strings = strings[np.lexsort(strings.T[::-1])]
    fields = {f: rng.integers(0, 100, 500) for f, _ in repeats._FIELDS}
    import zstandard

    got, shared, out = repeats.decoded(zstandard.ZstdDecompressor().decompress(repeats.front_coded(strings, fields)))
    assert got == [bytes(s) for s in strings] and all((out[f] == fields[f]).all() for f in fields)
    assert all(a[:n] == b[:n] for a, b, n in zip(got, got[1:], shared[1:]))


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(6)
    for count in (1, 2, 3, 7, 16):
        runs, texts = [], []
        for _ in range(count):
            own = sorted(bytes(rng.choice(b"ab") for _ in range(8)) for _ in range(rng.randrange(0, 40)))
            prefix = lambda x, y: next((i for i in range(8) if x[i] != y[i]), 8)
            shared = [0, *(prefix(x, y) for x, y in zip(own, own[1:]))][: len(own)]
            runs.append(([int.from_bytes(s, "big") for s in own], shared))
            texts.append(own)
        out = list(repeats.merged(runs, 8))
        strings = [texts[r][i] for _, r, i in out]
        assert strings == sorted(s for t in texts for s in t)
        assert all(n == prefix(x, y) for x, y, (n, _, _) in zip(strings, strings[1:], out[1:]))


def test_ranges_where_few_texts_are_long(spark):
    rng = random.Random(9)
    long = [prose(rng, 3000) for _ in range(3)]
    docs = spark.createDataFrame([(i, "short") for i in range(4000)] + [(5000 + i, t) for i, t in enumerate(long)], "doc_id long, text string")
    some = docs.filter("octet_length(text) >= 200")
    assert len(repeats._splitters(some, 3, 8)) == 7
    # a repeat that begins beyond the sampled bytes of a long text
    texts = [prose(rng, 9000) + long[0][:700], long[0][:700] + "x", "y" + long[0][:700]]
    compared(spark, texts + ["short"] * 50)
