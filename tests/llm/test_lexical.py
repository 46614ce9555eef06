"""Ranked lexical search against scores computed document by document."""

import math
import re
from collections import Counter

import pytest

from adtally.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    filled = [b for _, b in bags if b]
    n_docs, n_words = len(filled), sum(b.total() for b in filled)
    df = Counter(t for b in filled for t in b)
    out = []
    for item, text in items:
        asked = {t for t in terms_of(text) if df[t]}
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in asked}
        scores = []
        for i, b in bags:
            if b:
                m = 10 + 90 * b.total() * n_docs // n_words
                s = sum(weight[t] * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in asked if b[t])
                if s > 0:
                    scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, **more):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lexical.search(frame, asked, **more).collect()), key=str)


def corpus(n):
    """Common words in nearly all documents, rarer ones by divisibility, some exact copies."""
    docs = []
    for i in range(n):
        words = ["the", "and"] * (1 + i % 5) + [f"d{p}" for p in (2, 3, 5, 7, 11, 13, 17, 97) if i % p == 0] + ["filler"] * (i % 23)
        docs.append((i, " ".join(words) if i % 10 else "The same, the SAME text and d3"))
    return docs


ITEMS = [(1, "the and d2 d97"), (2, "D13 d17, unknown"), (3, "same text the"), (4, "the"), (5, "d3 d5 d7 d11 filler " * 3)]


@pytest.mark.parametrize("sizes", [(4096, 256), (16, 2), (64, 1)])
def test_against_each_document(spark, sizes):
    docs = corpus(600)
    assert found(spark, docs, ITEMS, block_docs=sizes[0], bundle_items=sizes[1]) == brute(docs, ITEMS)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,-_ "), (None, "alpha beta"), (4, "alpha beta"), (4, "alpha beta"), (5, "Ñu ñu ÉTÉ alpha"), (6, "KK 東京 x9")]
    items = [(1, "ALPHA"), (1, "alpha alpha"), (None, "ñu 東京"), (2, None), (3, ""), (4, "K k"), (5, "never")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, k=1) == brute(docs, items, 1)


def test_empty_tables_and_clashing_columns(spark):
    docs, items = [(1, "alpha")], [(1, "alpha")]
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, [(1, None)], items) == []
    wide = spark.createDataFrame([(1, "alpha", 3, 4, "x")], "doc_id long, text string, row long, rank int, score string")
    asked = spark.createDataFrame([(9, "alpha", 1)], "item_id long, text string, doc_id long")
    assert [tuple(r)[:3] for r in lexical.search(wide, asked).collect()] == [(9, 1, 1)]


def test_very_long_text(spark):
    long = " ".join(f"w{i % 5003}" for i in range(500_000)) + " " + "v" * 2_000_000
    docs = [(1, long), (2, "w1 w2 the"), (3, "the the")]
    items = [(1, "w1 w5002 the"), (2, "v" * 2_000_000)]
    assert found(spark, docs, items) == brute(docs, items)
