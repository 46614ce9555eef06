"""Nearest neighbours: recall against brute force, exact scores, ties and odd vectors."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtally.llm import ann, queries

SF = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, query string, parts int"


def asked():
    return F.col("vec_id") % 50 == 0


def clusters(n, d=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((30, d))
    return (centres[rng.integers(0, 30, n)] + 0.5 * rng.standard_normal((n, d))).astype("float32")


def rows_of(x, start=0):
    return [(start + i, [float(v) for v in row], "", 0) for i, row in enumerate(x)]


def brute(x, ids, k):
    x = x.astype(np.float64)
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        score = np.round(unit @ unit[i], 12)
        order = np.lexsort((ids, -score))
        out[ids[i]] = [(ids[j], score[j]) for j in order if ids[j] != ids[i]][:k]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_with_learned_partitions(spark):
    x = clusters(6000)
    want = brute(x, np.arange(len(x)), 5)
    got = results(ann.search(spark.createDataFrame(rows_of(x), SCHEMA).repartition(3), asked(), k=5, sample_rows=3000))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert recall(got, want) >= 0.95
    for q, found in got.items():
        known = dict(want[q])
        assert all(abs(known[i] - s) < 1e-9 for i, s in found if i in known)


def test_small_tables_are_searched_whole_with_ties(spark):
    x = clusters(300)
    x[20:60] = x[0]  # forty copies: ties go to the smaller id
    x[70] = 2 * x[50]
    odd = [(1000, None, "", 0), (1050, [0.0] * 16, "", 0), (1100, [float("nan")] * 16, "", 0), (1101, [1.0] * 15 + [None], "", 0)]
    odd += [(1102, [1.0] * 15 + [float("inf")], "", 0), (1150, [1.0, 2.0], "", 0), (None, [1.0] * 16, "", 0), rows_of(x)[3]]
    got = results(ann.search(spark.createDataFrame(rows_of(x) + odd, SCHEMA), asked(), k=5))
    want = brute(x, np.arange(300), 5)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_fewer_candidates_than_asked_and_none(spark):
    got = results(ann.search(spark.createDataFrame(rows_of(clusters(3)), SCHEMA), asked(), k=5))
    assert [i for i, _ in got[0]] and len(got[0]) == 2
    assert ann.search(spark.createDataFrame([], SCHEMA), asked()).count() == 0
    assert ann.search(spark.createDataFrame(rows_of(clusters(1)), SCHEMA), asked()).count() == 0


def test_parts_are_balanced_and_cut_few_edges():
    x = ann._unit(clusters(2048).astype(np.float64))
    edges = ann.neighbour_graph(x, 10)
    part = ann.balanced_parts(len(x), edges, 3)
    sizes = np.bincount(part)
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 3
    cut = (part[edges[:, 0]] != part[edges[:, 1]]).mean()
    random = np.random.default_rng(0).permutation(part)
    assert cut < 0.35 * (random[edges[:, 0]] != random[edges[:, 1]]).mean()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_recall_on_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = brute(np.array([r.embedding for r in rows]), np.array([r.vec_id for r in rows]), 5)
    got = results(queries.op8_learned_partitions(spark, SF))
    assert set(got) == set(want)
    assert recall(got, want) >= 0.9
