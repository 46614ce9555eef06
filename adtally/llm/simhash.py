"""SimHash near-duplicates: fuzzy keys from a perfect Golay code, joined and verified.

A 64-bit fingerprint is cut into three segments (22, 21 and 21 bits, taken as words of 23
bits with zeros above). The binary (23, 12) Golay code is perfect: every word lies within
three bits of exactly one codeword, so decoding maps a segment to a 12-bit index. A
segment's keys are the indices of itself and of all words one bit away; most segments have
six, the rest one. Two segments that differ in at most one bit always share keys: each
one's own index is among the other's.

Pigeonhole: with at most three differing bits over three segments, two segments differ in
at most one bit each, or one of them in none. So for each pair of segments a fingerprint
is filed under (own index, each key of the other) and (each key, own index of the other);
if u and v differ by at most one bit in both segments, (index of u in the first, index of
v in the second) is a key of both. That is 29 keys a fingerprint on average.

Only distinct fingerprints are filed, so exact copies cost one entry. Within a bucket, all
members are compared (exact bit distance), but only a spanning forest is handed on where
links are dense. Components of those links, over all buckets, are the answer.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.graph import connected_components
from adtally.llm.shared import free_name, python_ready, written

#: Generator polynomial of the binary (23, 12) Golay code (fixed value).
GOLAY_GENERATOR = 0b110001110101
#: Segments of a 64-bit fingerprint: lowest bit and width.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 3
#: Within a task, hashes are counted and buckets compared in pieces of so many rows.
PIECE = 1 << 14


# --- fingerprints ------------------------------------------------------------------------


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a whole text (0 without a word)."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)
    n = len(words) - shingle_words + 1
    shingles = map(b" ".join, zip(*(itertools.islice(words, k, None) for k in range(shingle_words))))
    hashes = map(xxhash.xxh64_intdigest, shingles, itertools.repeat(HASH_SEED))
    ones = np.zeros(64, np.int64)
    for start in range(0, n, PIECE):
        h = np.fromiter(hashes, "<u8", min(PIECE, n - start))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the SimHash of ``text_col`` as a signed long in the new column ``name``."""
    python_ready(docs)
    at, names = docs.columns.index(text_col), [*docs.columns, name]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            fps = np.array([fingerprint(t.as_py(), shingle_words) for t in texts], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(add, f"{fields}, `{name}` bigint")


# --- Golay keys --------------------------------------------------------------------------


@cache
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes by (byte position, byte), and the error of at most 3 bits by syndrome."""
    bit = []
    for i in range(24):
        rest = 1 << i
        for j in range(i, 10, -1):
            if rest >> j & 1:
                rest ^= GOLAY_GENERATOR << (j - 11)
        bit.append(rest)
    by_byte = np.zeros((3, 256), np.uint32)
    for place, value, i in itertools.product(range(3), range(256), range(8)):
        if value >> i & 1:
            by_byte[place, value] ^= bit[8 * place + i]
    errors = np.zeros(2048, np.uint32)
    for weight in range(4):
        for places in itertools.combinations(range(23), weight):
            syndrome = 0
            for i in places:
                syndrome ^= bit[i]
            errors[syndrome] = sum(1 << i for i in places)
    return by_byte, errors


def golay_index(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    by_byte, errors = _golay()
    syndrome = by_byte[0, words & 255] ^ by_byte[1, words >> 8 & 255] ^ by_byte[2, words >> 16]
    return (words ^ errors[syndrome]) >> 11


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (key, row) of unsigned fingerprints; a row has each of its keys once."""
    own, near = [], []
    for low, width in SEGMENTS:
        words = (fps >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.uint32)
        flips = words[:, None] ^ np.concatenate(([0], 1 << np.arange(width))).astype(np.uint32)
        near.append(golay_index(flips).astype(np.int64))
        own.append(near[-1][:, :1])
    keys = []
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        keys += [pair << 24 | own[i] << 12 | near[j], pair << 24 | near[i] << 12 | own[j]]
    keys = np.sort(np.concatenate(keys, axis=1), axis=1)
    first = np.ones(keys.shape, bool)
    first[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return keys[first], np.nonzero(first)[0]


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        for start in range(0, len(fps), PIECE // 4):
            part = fps[start : start + PIECE // 4]
            keys, rows = bucket_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(part[rows])], ["key", "fp"])


# --- links within buckets ----------------------------------------------------------------


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among ``fps``: each step compares one with all unreached."""
    out, left = [], np.arange(len(fps))
    while left.size > 1:
        reached, left = [left[0]], left[1:]
        while reached and left.size:
            u = reached.pop()
            near = np.bitwise_count(fps[left] ^ fps[u]) <= max_bits
            if near.any():
                found, left = left[near], left[~near]
                out.append((np.full(found.size, u), found))
                reached.extend(found)
    return out


def bucket_links(keys: np.ndarray, fps: np.ndarray, max_bits: int, dense: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Links (a > b as rows' fingerprints) that connect what is linked within each bucket.

    Rows come sorted by key. Buckets of up to ``dense`` members are compared all at once,
    step by step over the distance of rows; larger ones by forest().
    """
    cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    sizes = np.diff(cuts)
    a, b = [], []
    for k in np.flatnonzero(sizes > dense):
        part = fps[cuts[k] : cuts[k + 1]]
        for x, y in forest(part, max_bits):
            a.append(part[x])
            b.append(part[y])
    of = np.repeat(sizes, sizes)
    place = np.arange(len(keys)) - np.repeat(cuts[:-1], sizes)
    for step in range(1, min(dense, int(sizes.max(initial=0)))):
        rows = np.flatnonzero((of <= dense) & (place + step < of))
        near = rows[np.bitwise_count(fps[rows] ^ fps[rows + step]) <= max_bits]
        a.append(fps[near])
        b.append(fps[near + step])
    if not a:
        return fps[:0], fps[:0]
    a, b = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _links(max_bits: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int32), np.empty(0, np.uint64)

        def done(k, f):
            a, b = bucket_links(k, f, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            # the last bucket may go on in the next batch
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if whole:
                yield done(keys[:whole], fps[:whole])
                keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            yield done(keys, fps)

    return link


# --- operator ----------------------------------------------------------------------------


def fingerprint_classes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, root`` for each distinct fingerprint of ``fps (fp long)`` that has a link.

    Exact for ``max_bits`` up to 3: every pair within that distance shares a key.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the keys cover bit distances from 0 to 3")
    python_ready(fps)
    filed = fps.select("fp").filter("fp is not null").distinct().mapInArrow(_file, "key int, fp bigint")
    buckets = filed.repartition("key").sortWithinPartitions("key", "fp")
    links = buckets.mapInArrow(_links(max_bits), "a bigint, b bigint")
    return connected_components(links).select(F.col("node").alias("fp"), "root")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp (signed), component_id``.

    Null and wordless texts have fingerprint zero and link like any other. A null id never
    names a component unless all its ids are null. Repeated rows stay repeated. An empty
    table gives an empty result. Other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(with_fingerprint(rows, "fp", "text", shingle_words).drop("text"), "fingerprints")
    return rows.join(_named_classes(rows, max_bits).select("fp", "component_id"), "fp")


def _named_classes(rows: DataFrame, max_bits: int) -> DataFrame:
    """``fp, root, component_id`` of every distinct fingerprint of ``rows (doc_id, fp)``."""
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    classes = least.join(fingerprint_classes(rows, max_bits), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    classes = written(classes, "classes")
    return classes.join(classes.groupBy("root").agg(F.min("low").alias("component_id")), "root")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest id.

    Rows that repeat this id with a fingerprint of the same component count as one; of
    equal ids the smallest fingerprint stays. Ids that are all null leave one row.
    """
    fp, row_id = free_name(docs, "fp"), free_name(docs, "kept_id")
    rows = written(with_fingerprint(docs, fp, text_col, shingle_words), "documents_fp")
    ids = rows.select(F.col(id_col).alias("doc_id"), F.col(fp).alias("fp"))
    classes = _named_classes(ids, max_bits)
    chosen = (
        ids.join(classes, "fp")
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root").agg(F.min(F.struct("doc_id", "fp")).alias("s"))
        .select(F.col("s.doc_id").alias(row_id), F.col("s.fp").alias(fp + "_kept"))
    )
    same = rows[id_col].eqNullSafe(chosen[row_id]) & (rows[fp] == chosen[fp + "_kept"])
    return rows.join(chosen, same, "left_semi").dropDuplicates([id_col, fp]).select(*docs.columns)
