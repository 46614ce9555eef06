"""Approximate nearest neighbours by cosine over learned, balanced partitions.

The index is fitted on a bounded sample: its k-nearest-neighbour graph is cut into parts
of equal size by recursive bisection (the graph's second eigenvector gives a first order,
exchanges of the nodes with the most to gain then shorten the cut). A small neural network
learns to tell a vector's part. Every row is filed under its most probable part; a query
looks into its several most probable parts, as many as reach the target recall on queries
drawn from the sample, where the truth is known.

Parts are worked on in blocks of bounded size: rows and queries of a part are dealt over
blocks by a hash of their id, so a part swollen by copies becomes more blocks, not a larger
task. Candidates are reranked by exact cosine in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adtally.llm.shared import python_ready, written

#: At most so many vectors, those of least hashed id, are fitted on.
SAMPLE_ROWS = 8192
#: Vectors of the sample in a part, about.
PART_ROWS = 256
NEIGHBOURS = 10
HIDDEN = 128
STEPS = 400
TARGET_RECALL = 0.98
PROBE_QUERIES = 1024
#: Rows and queries of one block.
BLOCK_ROWS = 2048
BLOCK_QUERIES = 1024


def usable(vec: Column) -> Column:
    """Not null or zero, and without null or non-finite components."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# --- the index ---------------------------------------------------------------------------


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Edges (i, j) from each unit vector to its k nearest others."""
    out = []
    for start in range(0, len(x), 1024):
        near = x[start : start + 1024] @ x.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = -2
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        out.append(np.stack([np.repeat(np.arange(start, start + len(near)), k), top.ravel()], axis=1))
    return np.concatenate(out)


def bisect(n: int, edges: np.ndarray, rng: np.random.Generator, passes: int = 8) -> np.ndarray:
    """A bool for each of n nodes; both sides differ in size by at most one; few edges cross."""
    a, b = edges[:, 0], edges[:, 1]
    degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1e-9
    v = rng.standard_normal(n)
    for _ in range(60):  # power iteration of the lazy walk, the constant vector taken out
        v = (v + (np.bincount(a, v[b], n) + np.bincount(b, v[a], n)) / degree) / 2
        v -= (v * degree).sum() / degree.sum()
        v /= np.abs(v).max() or 1.0
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2 :]] = True
    for _ in range(passes):
        cross = (side[a] != side[b]) * 2.0 - 1
        gain = np.bincount(a, cross, n) + np.bincount(b, cross, n)
        left, right = (np.flatnonzero(s)[np.argsort(-gain[s], kind="stable")] for s in (~side, side))
        m = min(len(left), len(right))
        worth = np.flatnonzero(gain[left[:m]] + gain[right[:m]] > 0)
        # half of what pays: nodes that move at once may be each other's neighbours
        take = worth[: max(len(worth) // 2, 1)] if worth.size else worth
        if not take.size:
            break
        before, moved = cross.sum(), side.copy()
        moved[left[take]], moved[right[take]] = True, False
        if ((moved[a] != moved[b]) * 2.0 - 1).sum() >= before:
            break
        side = moved
    return side


def balanced_parts(n: int, edges: np.ndarray, depth: int, seed: int = 7) -> np.ndarray:
    """Part numbers from 0 to 2**depth - 1 of equal size, by recursive bisection."""
    rng = np.random.default_rng(seed)
    part = np.zeros(n, np.int64)
    for _ in range(depth):
        nodes_of = [np.flatnonzero(part == p) for p in range(part.max() + 1)]
        inner = edges[part[edges[:, 0]] == part[edges[:, 1]]]
        of_edge = part[inner[:, 0]]
        new = np.zeros(n, np.int64)
        for p, nodes in enumerate(nodes_of):
            local = np.zeros(n, np.int64)
            local[nodes] = np.arange(len(nodes))
            new[nodes] = 2 * p + bisect(len(nodes), local[inner[of_edge == p]], rng)
        part = new
    return part


@dataclass(frozen=True)
class Router:
    """Unit vector -> scores of the parts, by one hidden layer; ``probes`` parts are searched."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def ranked(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :n]

    @classmethod
    def fit(cls, x: np.ndarray, part: np.ndarray, parts: int, seed: int = 7) -> Router:
        """Softmax regression behind a rectified layer, by Adam on random batches."""
        rng = np.random.default_rng(seed)
        shapes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,)]
        w = [rng.standard_normal(s) * math.sqrt(2 / s[0]) if len(s) == 2 else np.zeros(s) for s in shapes]
        m, v = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
        for step in range(1, STEPS + 1):
            at = rng.integers(0, len(x), 512)
            batch = x[at]
            hidden = np.maximum(batch @ w[0] + w[1], 0)
            logits = hidden @ w[2] + w[3]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), part[at]] -= 1
            p /= len(at)
            back = (p @ w[2].T) * (hidden > 0)
            for k, g in enumerate((batch.T @ back, back.sum(axis=0), hidden.T @ p, p.sum(axis=0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return cls(*w)


def fit(sample: np.ndarray, k: int, target: float = TARGET_RECALL) -> Router:
    """A router from the sample's vectors; copies count once. Few vectors make one part."""
    x = _unit(np.unique(sample, axis=0))
    depth = max(0, round(math.log2(max(len(x) / PART_ROWS, 1))))
    if depth == 0:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    part = balanced_parts(len(x), neighbour_graph(x, NEIGHBOURS), depth)
    router = Router.fit(x, part, 1 << depth)
    # probes: as many as find the true neighbours of sampled queries among the sample
    at = np.random.default_rng(7).permutation(len(x))[:PROBE_QUERIES]
    near = x[at] @ x.T
    near[np.arange(len(at)), at] = -2
    truth = np.argpartition(-near, k - 1, axis=1)[:, :k]
    home = router.ranked(x, 1)[:, 0]
    order = router.ranked(x[at], 1 << depth)
    rank = (order[:, None, :] == home[truth][:, :, None]).argmax(axis=2)
    probes = next(p for p in range(1, (1 << depth) + 1) if (rank < p).mean() >= target or p == 1 << depth)
    return Router(router.w1, router.b1, router.w2, router.b2, probes)


# --- search ------------------------------------------------------------------------------


def _file(router, words: int):
    """Rows of (vec_id, vec, query) with their part as a row, and their parts as a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack(batch.column(1).to_numpy(zero_copy_only=False))
            parts = router.value.ranked(_unit(x), router.value.probes).astype(np.int32)
            listed = pa.ListArray.from_arrays(np.arange(0, parts.size + 1, parts.shape[1], dtype=np.int32), parts.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], ["vec_id", "vec", "query", "parts"])

    return run


def rerank(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of each query by exact cosine; ties to the smaller id.

    Only the first k + 1 ids of equal vectors can be among the k nearest, so the others
    are left out before scoring.
    """
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(rows) and len(queries):
        rows = rows.drop_duplicates("vec_id").sort_values("vec_id")
        ids, x = rows["vec_id"].to_numpy(), np.stack(rows["vec"].to_numpy()).astype(np.float64)
        same = np.unique(x, axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(same, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], same[order][1:] != same[order][:-1])))
        nth = np.empty(len(ids), np.int64)
        nth[order] = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
        ids, x = ids[nth <= k], x[nth <= k]
        unit, norms = _unit(x), np.sqrt((x * x).sum(axis=1))
        q = np.stack(queries["q_vec"].to_numpy()).astype(np.float64)
        near = _unit(q) @ unit.T
        for i, (query_id, scores) in enumerate(zip(queries["q_vec_id"].to_numpy(), near)):
            scores = np.where(ids == query_id, -np.inf, scores)
            m = min(k, len(ids))
            at = np.flatnonzero((scores >= np.partition(scores, len(ids) - m)[len(ids) - m] - 1e-9) & (scores > -np.inf))
            exact = (x[at] * q[i]).sum(axis=1) / (norms[at] * np.sqrt((q[i] * q[i]).sum()))
            best = np.lexsort((ids[at], -exact))[:k]
            out["query_id"] += [query_id] * len(best)
            out["vec_id"] += ids[at][best].tolist()
            out["score"] += exact[best].tolist()
    return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def search(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for each query row.

    ``is_query`` is a condition on the column ``vec_id``. Null ids, unusable vectors and
    vectors of another than the commonest length (the shorter of two as common) take no
    part. Rows that share the query's id are the query's own; a candidate id counts once.
    An empty table gives an empty result.
    """
    spark = python_ready(vectors)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    found = "query_id bigint, vec_id bigint, score double"
    if lengths is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.size("vec") == lengths.n)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vec").collect()
    router = spark.sparkContext.broadcast(fit(np.array([r.vec for r in sample]), k))

    filed = rows.withColumn("query", F.coalesce(is_query, F.lit(False))).mapInArrow(
        _file(router, lengths.n), "vec_id bigint, vec array<double>, query boolean, parts array<int>"
    )
    filed = written(filed, "filed")
    # blocks of a part: as many as its rows and queries need, a few numbers a part
    by_part = filed.groupBy(F.col("parts")[0].alias("part")).count()
    asked = filed.filter("query").select(F.explode("parts").alias("part")).groupBy("part").count()
    counts = by_part.join(asked.withColumnRenamed("count", "asked"), "part").select(
        "part",
        F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("row_blocks"),
        F.ceil(F.col("asked") / BLOCK_QUERIES).cast("int").alias("query_blocks"),
    )
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = (
        filed.select(F.col("parts")[0].alias("part"), "vec_id", "vec").join(F.broadcast(counts), "part")
        .withColumn("rb", dealt("row_blocks")).withColumn("qb", every("query_blocks")).select("part", "rb", "qb", "vec_id", "vec")
    )
    wanted = (
        filed.filter("query").select(F.explode("parts").alias("part"), "vec_id", "vec").join(F.broadcast(counts), "part")
        .withColumn("qb", dealt("query_blocks")).withColumn("rb", every("row_blocks"))
        .select(*[F.col(c).alias(f"q_{c}") for c in ("part", "rb", "qb", "vec_id", "vec")])
    )
    key = ["part", "rb", "qb"]
    hits = held.groupBy(key).cogroup(wanted.groupBy([f"q_{c}" for c in key])).applyInPandas(lambda r, q: rerank(r, q, k), found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
