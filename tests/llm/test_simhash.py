"""SimHash and Golay keys against brute force."""

import itertools
import random

import numpy as np
import xxhash

from adtally.llm import simhash

SCHEMA = "doc_id long, text string, fp string, kept_id int"


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(ids, fps):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            parent[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(least.get(find(i), x), x)
    return [least.get(find(i)) for i in range(len(ids))]


def texts(rng, n):
    words = [f"w{k}" for k in range(60)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            old = rng.choice(out).split(" ")
            for _ in range(rng.randrange(4)):
                old[rng.randrange(len(old))] = rng.choice(words)
            out.append(" ".join(old))
        else:
            out.append(" ".join(rng.choice(words) for _ in range(rng.randrange(20, 300))))
    return out


def test_golay_code_is_perfect():
    words = np.arange(1 << 14, dtype=np.uint32) * np.uint32(511)
    index = simhash.golay_index(words & np.uint32((1 << 23) - 1))
    assert index.max() < 1 << 12
    # up to three flips of a codeword lead back to it
    zero = simhash.golay_index(np.array([sum(1 << i for i in c) for c in itertools.combinations(range(23), 3)], np.uint32))
    assert (zero == 0).all()


def test_any_three_flips_share_a_key():
    rng = random.Random(1)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(4)):
            b ^= 1 << bit
        keys, rows = simhash.bucket_keys(np.array([a, b], np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_forest_connects_what_is_linked():
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(3)]
    fps = list({b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(60)})
    keys = np.zeros(len(fps), np.int32)
    want = brute_components(list(range(len(fps))), fps)
    for dense in (4, 1000):
        a, b = simhash.bucket_links(keys, np.array(fps, np.uint64), 3, dense)
        label = {f: f for f in fps}
        for _ in fps:
            for x, y in zip(a.tolist(), b.tolist()):
                label[x] = label[y] = min(label[x], label[y])
        assert len(set(label.values())) == len(set(want))
        assert all((x ^ y).bit_count() <= 3 for x, y in zip(a.tolist(), b.tolist()))


def test_components_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, t, "x", 0) for i, t in enumerate(texts(rng, 120))]
    rows += [(200, None, "x", 0), (201, "", "x", 0), (202, " \t\n", "x", 0), (203, "One", None, 0), (204, "one two", "x", 1)]
    rows += [(205, "ONE  two", "x", 0), (None, rows[5][1], "x", 0), (206, "é " * 30000, "x", 0), rows[7], (207, "ÀÉ é", "x", 0)]
    rng.shuffle(rows)
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [brute_fingerprint(t) for _, t, _, _ in rows]
    want = brute_components([r[0] for r in rows], fps)
    key = lambda r: repr(r)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in found), key=key) == sorted(
        ((r[0], f, c) for r, f, c in zip(rows, signed, want)), key=key
    )


def test_one_of_each_group_stays(spark):
    rng = random.Random(4)
    rows = [(i, t, "x", i) for i, t in enumerate(texts(rng, 80))]
    rows += [(90, None, "n", 1), (91, "", "n", 1), rows[3], (92, rows[3][1], "y", 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = {c for c in brute_components([r[0] for r in rows], fps)}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(want)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0
