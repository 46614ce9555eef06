"""Importance resampling towards a target: documents whose n-grams look like the target's.

N-grams fall into a fixed number of buckets. A bucket's gain compares its share in the
target with its share in the corpus; a document's weight is the mean gain of its n-grams.
Gumbel noise drawn from the document's id is added, and the documents with the largest
sums are drawn: a sample without replacement by weight, the same in every run.

Within a task, the n-grams of a batch of texts are interned in an open-addressed table of
NumPy arrays: XXH64 gives the first slot of an n-gram, its bytes are compared with those
of the slot's holder, and what differs goes on to the next slot. A slot keeps its
n-gram's bucket and count, so a checksum is taken once for each different n-gram of a
batch, and the gains of all occurrences are gathered by their slots.

Only sums by bucket, at most ``buckets`` rows, come together on the driver. Ranks come
from a histogram of the scores, so no task sorts the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.shared import python_ready, written
from adtally.llm.words import PIECE, lowered, pieces

BUCKETS = 10_000
MAX_N = 1
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
#: Copies of one row are written out so many at a time.
COPIES = 1 << 16

# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
#: Keys of so many bytes or more are hashed one by one.
_LONG = 32
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _lanes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as little-endian numbers."""
    rows = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1), writeable=False)
    return rows[at].view("<u8")[:, 0]


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of each stretch of ``data``, which has 8 bytes more than they reach."""
    h = _P5 + lengths.astype(np.uint64)
    at = starts.copy()
    for k in range(1, _LONG // 8):
        i = np.flatnonzero((lengths >= 8 * k) & (lengths < _LONG))
        lane = _turned(_lanes(data, at[i]) * _P2, 31) * _P1
        h[i] = _turned(h[i] ^ lane, 27) * _P1 + _P4
        at[i] += 8
    i = np.flatnonzero((lengths & 4 > 0) & (lengths < _LONG))
    h[i] = _turned(h[i] ^ (_lanes(data, at[i]) & _MASKS[4]) * _P1, 23) * _P2 + _P3
    at[i] += 4
    for k in range(1, 4):
        i = np.flatnonzero((lengths & 3 >= k) & (lengths < _LONG))
        h[i] = _turned(h[i] ^ data[at[i]] * _P5, 11) * _P1
        at[i] += 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(lengths >= _LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]].tobytes())
    return h


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the stretches that start at ``a`` and ``b`` hold the same bytes."""
    same = np.ones(len(a), bool)
    left = np.arange(len(a))
    k = 0
    while left.size:
        rest = np.minimum(lengths[left] - k, 8)
        differ = (_lanes(data, a[left] + k) ^ _lanes(data, b[left] + k)) & _MASKS[rest]
        same[left[differ != 0]] = False
        k += 8
        left = left[(differ == 0) & (lengths[left] > k)]
    return same


class GramTable:
    """The different n-grams of one batch, in open-addressed slots."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashed: Callable = xxh64):
        size = 1 << max(4, int(2 * len(starts)).bit_length())
        keys = hashed(data, starts, lengths)
        holder = np.full(size, -1, np.int64)
        slot = (keys & np.uint64(size - 1)).astype(np.int64)
        open_ = np.arange(len(starts))
        while open_.size:
            at = slot[open_]
            free = holder[at] < 0
            holder[at[free]] = open_[free]
            held = holder[at]
            same = (keys[held] == keys[open_]) & (lengths[held] == lengths[open_])
            i = np.flatnonzero(same)
            same[i] = _equal(data, starts[held[i]], starts[open_[i]], lengths[open_[i]])
            open_ = open_[~same]
            slot[open_] = (slot[open_] + 1) & (size - 1)
        #: The slot of each occurrence, and for each slot the count of its n-gram.
        self.slot_of, self.count = slot, np.bincount(slot, minlength=size)
        self._data, self._starts, self._lengths, self._holder = data, starts, lengths, holder

    def buckets(self, n: int) -> np.ndarray:
        """For each slot, the bucket of its n-gram: the checksum of its bytes modulo ``n``."""
        out = np.zeros(len(self._holder), np.int64)
        taken = np.flatnonzero(self._holder >= 0)
        first = self._holder[taken]
        data, begin, end = self._data.tobytes(), self._starts[first], self._starts[first] + self._lengths[first]
        crc = zlib.crc32
        out[taken] = [crc(data[a:b]) % n for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        return out


def grams(parts: list[tuple[int, bytes, int]], max_n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, lengths, owners) of all runs of 1 to ``max_n`` words that begin in a part's own bytes.

    ``data`` holds the words parted by single blanks, so that each run is one stretch of it.
    """
    raw = np.frombuffer(b" " + b"\n".join(p for _, p, _ in parts) + b" ", np.uint8)
    word = raw > 32
    first = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    ends = np.cumsum([len(p) + 1 for _, p, _ in parts])
    part = np.searchsorted(ends, first - 1, "right")
    limit = 1 + ends - np.array([len(p) + 1 for _, p, _ in parts]) + np.array([own for _, _, own in parts])
    keep = word.copy()
    keep[first - 1] = True
    data = raw[keep]
    data[data == 10] = 32
    blanks = np.flatnonzero(data == 32)
    begin = blanks + 1
    end = np.append(blanks[1:], len(data))[: len(begin)]
    owner = np.array([o for o, _, _ in parts])[part]
    own = first < limit[part]
    starts, lengths, owners = [], [], []
    for k in range(max_n):
        n = max(len(begin) - k, 0)
        whole = own[:n] & (part[:n] == part[k:])
        starts.append(begin[:n][whole])
        lengths.append(end[k:][whole] - begin[:n][whole])
        owners.append(owner[:n][whole])
    data = np.concatenate([data, np.zeros(16, np.uint8)])
    return data, np.concatenate(starts), np.concatenate(lengths), np.concatenate(owners)


def _parts(texts: list[str | None], max_n: int) -> Iterator[list[tuple[int, bytes, int]]]:
    """Lists of (owner, part, own bytes) of about PIECE bytes."""
    out, size = [], 0
    for owner, text in enumerate(texts):
        for part, own in pieces(lowered(text), max_n - 1):
            out.append((owner, part, own))
            size += len(part) + 1
            if size >= PIECE:
                yield out
                out, size = [], 0
    if out:
        yield out


def bucket_counts(docs: DataFrame, text_col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: occurrences of n-grams by bucket, summed in each task before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for parts in _parts(batch.column(0).to_pylist(), max_n):
                table = GramTable(*grams(parts, max_n)[:3])
                total += np.bincount(table.buckets(buckets), table.count, minlength=buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["bucket", "n"])

    python_ready(docs)
    own = docs.select(text_col).mapInArrow(counted, "bucket long, n long")
    return own.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket in thousandths, from the counts of corpus and target.

    ``buckets`` numbers: all that is gathered from the corpus.
    """
    both = corpus.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full")
    s, t = np.zeros(buckets), np.zeros(buckets)
    for r in both.collect():
        s[r.bucket], t[r.bucket] = r.s or 0, r.t or 0
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(
    docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_n: int = MAX_N,
) -> DataFrame:
    """``id_col, n_words, n_features, weight`` for each row: the floored mean gain of its n-grams."""  # noqa: D205

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            total, features, words = (np.zeros(n, np.int64) for _ in range(3))
            for parts in _parts(batch.column(1).to_pylist(), max_n):
                data, starts, lengths, owners = grams(parts, max_n)
                table = GramTable(data, starts, lengths)
                of_slot = gain[table.buckets(len(gain))]
                # sums of whole numbers below 2^53 are exact in doubles
                total += np.bincount(owners, of_slot[table.slot_of], n).astype(np.int64)
                features += np.bincount(owners, minlength=n)
                if max_n > 1:
                    words += np.bincount(grams(parts, 1)[3], minlength=n)
            words = words if max_n > 1 else features
            mean = np.where(features > 0, total // np.maximum(features, 1), 0)
            arrays = [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, features, mean))]
            yield pa.RecordBatch.from_arrays(arrays, [id_col, "n_words", "n_features", "weight"])

    python_ready(docs)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(weighed, f"`{id_col}` {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from a row's key, the same in every run; null counts as a key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, id_col: str, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the drawn rows, by falling score, then rising id.

    Equal rows are counted first, so a repeated id is one row. How many rows have a larger
    score is known from the counts by score (scores are thousandths of logarithms: some ten
    thousand values at most); only rows of the same score are put in order.
    """
    columns = scored.columns
    groups = scored.groupBy(*columns).agg(F.count("*").alias("_copies"))
    fits = F.col("n_words") >= min_words
    scores = groups.filter(fits).groupBy("score").agg(F.sum("_copies").alias("_n"))
    above = F.coalesce(F.sum("_n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the window's one task gets a row for each score
    scores = written(scores.select("score", "_n", above.alias("_above")), "scores")
    total = scores.agg(F.sum("_n")).first()[0] or 0
    draw = percent * total // 100
    reach = scores.filter(F.col("_above") < draw).select("score", "_above")
    order = Window.partitionBy("score").orderBy(F.col(id_col).asc_nulls_last(), "n_features", "weight")
    before = F.coalesce(F.sum("_copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hit = groups.filter(fits).join(reach, "score")
    hit = hit.withColumn("_above", F.col("_above") + before)
    rest = groups.filter(~fits).unionByName(groups.filter(fits).join(reach, "score", "left_anti"))
    every = hit.unionByName(rest, allowMissingColumns=True)
    every = every.withColumn("_from", F.explode(F.sequence(F.lit(1), F.col("_copies"), F.lit(COPIES).cast("long"))))
    last = F.least(F.col("_copies"), F.col("_from") + COPIES - 1)
    every = every.withColumn("_copy", F.explode(F.sequence(F.col("_from"), last)))
    rank = F.col("_above") + F.col("_copy")
    return every.select(*columns, F.when(rank <= draw, rank).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    max_n: int = MAX_N, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
) -> DataFrame:
    """``id_col, n_words, n_features, weight, score, rank`` for each row of ``docs``.

    ``percent`` of the documents with at least ``min_words`` words are drawn; ``rank`` is
    null for all others. A null text has no words, weight 0 and its noise as its score.
    Ties go to the smaller id, a null id last; equal rows have ranks one after the other. An
    empty table gives an empty result, an empty target gains by rarity alone. Other columns
    are ignored.
    """  # noqa: D205
    corpus = bucket_counts(docs, text_col, max_n, buckets)
    gain = gains(corpus, bucket_counts(target, target_text_col, max_n, buckets), buckets)
    rows = weigh(docs, gain, id_col, text_col, max_n)
    rows = written(rows.withColumn("score", F.col("weight") + noise(F.col(id_col), seed)), "weighed")
    return ranked(rows, id_col, percent, min_words)
