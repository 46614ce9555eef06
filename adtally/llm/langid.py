"""Language identification with bit-sliced Bloom filters over character trigrams.

Trigrams are counted by language over all learning documents: each task counts its own
texts, Spark sums the counts. A language's profile is every trigram that makes up at least
``MIN_SHARE`` of its trigrams, so a profile has at most ``1 / MIN_SHARE`` entries however
large the corpus is, and the model is small enough to hand to every task.

All profiles share one table of ``SLOTS`` rows of bits, one bit a language. A trigram sets
its language's bit in ``HASHES`` rows; looking a trigram up is the AND of its rows, which
names all languages that hold it at once. A document's hits are counted by language. A row
that is filled by a share f of set bits reports a trigram falsely with probability
``f ** HASHES``; the expected number of such hits is taken off before languages compare.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.shared import python_ready, written

GRAM = 3
MIN_SHARE = 2e-5
SLOTS = 1 << 20
HASHES = 4
#: Characters worked on at once; longer texts go through in overlapping pieces.
PIECE = 1 << 19
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(id, place of its text) of every trigram with two letters or more.

    Texts are lower-cased, anything but letters counts as a blank, and a blank stands at
    both ends. An id holds the three code points, so different trigrams never share one.
    """
    joined = "\0".join(f" {t} " for t in (t.lower().replace("\0", " ") for t in texts))
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    ends = codes == 0
    letters = _letters()[codes]
    place = np.cumsum(ends)
    codes = np.where(letters, codes, 32)
    n = max(len(codes) - GRAM + 1, 0)
    ids, seen = np.zeros(n, np.int64), np.zeros(n, np.int8)
    for k in range(GRAM):
        ids = ids << 21 | codes[k : n + k]
        seen += letters[k : n + k]
    good = (seen >= 2) & (place[:n] == place[GRAM - 1 :][:n]) & ~ends[:n]
    return ids[good], place[:n][good]


def _pieces(texts: Iterator[tuple[int, str]]) -> Iterator[tuple[list[int], list[str]]]:
    """Lists of (owner, text) of about PIECE characters; long texts are cut, overlapping."""
    owners, parts, size = [], [], 0
    for owner, text in texts:
        for start in range(0, max(len(text) - GRAM + 1, 1), PIECE):
            part = text[start : start + PIECE + GRAM - 1]
            owners.append(owner)
            parts.append(part)
            size += len(part)
            if size >= PIECE:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def _summed(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, at = np.unique(ids, return_inverse=True)
    return unique, np.bincount(at, counts, len(unique)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram, n: counts of this task, handed on whenever a language has many trigrams."""
    known: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def out(lang: str) -> pa.RecordBatch:
        ids, counts = known.pop(lang)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(ids), pa.string()), pa.array(ids, pa.int64()), pa.array(counts, pa.int64())], ["lang", "gram", "n"])

    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            for _, parts in _pieces(enumerate(texts)):
                ids, counts = np.unique(trigrams(parts)[0], return_counts=True)
                if lang in known:
                    ids, counts = _summed(np.concatenate([known[lang][0], ids]), np.concatenate([known[lang][1], counts]))
                known[lang] = ids, counts
                if len(ids) > 1 << 20:
                    yield out(lang)
    for lang in list(known):
        yield out(lang)


@dataclass(frozen=True)
class Filters:
    """The bit-sliced table: ``rows[slot, word]`` holds 64 languages a word."""

    languages: tuple[str, ...]
    rows: np.ndarray
    false_share: np.ndarray
    usual: str

    @staticmethod
    def slots(grams: np.ndarray) -> list[np.ndarray]:
        """The rows of each trigram, by double hashing."""
        x = grams.astype(np.uint64)
        x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        first, step = x & np.uint64(SLOTS - 1), x >> np.uint64(40) | np.uint64(1)
        return [(first + np.uint64(k) * step & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(HASHES)]

    @classmethod
    def build(cls, profiles: dict[str, np.ndarray], usual: str) -> Filters:
        languages = tuple(sorted(profiles))
        rows = np.zeros((SLOTS, -(-max(len(languages), 1) // 64)), np.uint64)
        filled = np.zeros(len(languages))
        for k, lang in enumerate(languages):
            bit = np.zeros(SLOTS, bool)
            for at in cls.slots(profiles[lang]):
                bit[at] = True
            rows[:, k // 64] |= bit.astype(np.uint64) << np.uint64(k % 64)
            filled[k] = bit.mean()
        return cls(languages, rows, filled**HASHES, usual)

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams of each text, and how many of them each language holds."""
        grams, place = trigrams(texts)
        slots = self.slots(grams)
        masks = self.rows[slots[0]]
        for at in slots[1:]:
            masks &= self.rows[at]
        total = np.bincount(place, minlength=len(texts))
        held = np.zeros((len(texts), len(self.languages)), np.int64)
        for k in range(len(self.languages)):
            bit = masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)
            held[:, k] = np.bincount(place, bit, len(texts))
        return total, held

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        total = np.zeros(len(texts), np.int64)
        held = np.zeros((len(texts), len(self.languages)), np.int64)
        for owners, parts in _pieces((i, t) for i, t in enumerate(texts) if t):
            n, h = self.hits(parts)
            np.add.at(total, owners, n)
            np.add.at(held, owners, h)
        real = np.maximum(held - total[:, None] * self.false_share, 0) / np.maximum(1 - self.false_share, 1e-9)
        sums = real.sum(axis=1)
        out = []
        for i, text in enumerate(texts):
            if not self.languages or not text or not any(c.isalpha() for c in text):
                out.append((UNKNOWN, 0.0))
            elif not sums[i]:
                out.append((self.usual, 0.0))
            else:
                k = int(np.argmax(real[i]))
                out.append((self.languages[k], float(real[i, k] / sums[i])))
        return out


def learn(known: DataFrame, min_share: float = MIN_SHARE) -> Filters:
    """Filters of ``known (lang, text)``; rows with a null of either teach nothing.

    What comes to the driver is bounded: at most ``1 / min_share`` trigrams a language.
    Where no trigram gives a hit, the language with the most trigrams is the answer.
    """
    python_ready(known)
    rows = known.select(F.col("lang").cast("string"), F.col("text").cast("string")).filter("lang is not null and text is not null")
    counts = rows.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = counts.join(totals, "lang").filter(F.col("n") >= F.col("total") * F.lit(min_share))
    profiles = {r.lang: np.array(r.grams, np.int64) for r in frequent.groupBy("lang").agg(F.collect_list("gram").alias("grams")).collect()}
    usual = max(totals.collect(), key=lambda r: (r.total, [-ord(c) for c in r.lang]), default=None)
    return Filters.build(profiles, usual.lang if usual else UNKNOWN)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for each row, from its text alone.

    ``und`` with score 0 for a null text, a text without a letter, or when nothing was
    learned. Equal scores go to the language that sorts first. Score: the best language's
    share of all corrected hits. Repeated rows and null ids stay; an empty table gives none.
    """
    spark = python_ready(docs)
    shared = spark.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(batch.column(1).to_pylist())
            cols = [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double")
