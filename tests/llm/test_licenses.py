"""Licence scans against a plain version."""

import re
from collections import Counter

import pytest

from adtally.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def starts_of(words, part):
    return [i for i in range(len(words) - len(part) + 1) if words[i : i + len(part)] == part]


def brute(texts, counts=None):
    """(n_words, places, labels, score) of each text, with loops over all words and templates."""
    known = {w for t in licenses.TEMPLATES for w in words_of(t.text)}
    if counts is None:
        counts = Counter(w for t in texts for w in known & set(words_of(t)))
    rarest = lambda some, n: sorted(some, key=lambda w: (counts[w], w))[:n]
    out = []
    for text in texts:
        w = words_of(text)
        places = sorted((i, label) for p, label in licenses.PHRASES for i in starts_of(w, p.split()))
        rare = rarest(known & set(w), licenses.FILE_WORDS)
        where = {}
        for i, x in enumerate(w):
            where.setdefault(x, []).append(i)
        labels, best = {label for _, label in places}, 0.0
        for t in licenses.TEMPLATES:
            tw = words_of(t.text)
            own = rarest(set(tw), licenses.TEMPLATE_WORDS)
            votes = Counter()
            for r in set(own) & set(rare):
                votes.update({p - q for p in where[r] for q, x in enumerate(tw) if x == r})
            for begin, n in votes.items():
                if n >= min(licenses.AGREE, len(own)):
                    part = w[max(begin - licenses.SLACK, 0) : max(begin + len(tw) + licenses.SLACK, 0)]
                    if all(starts_of(part, words_of(p)) for p in t.phrases):
                        labels.add(t.label)
                        best = max(best, len(set(tw) & set(part)) / len(set(tw)))
        out.append((len(w), places, sorted(labels), 1.0 if places else best))
    return out


NOTICES = [t.text for t in licenses.TEMPLATES]
ODD = [
    None, "", " \n ", "the", "mit license apache", "gnu public version general license",
    "Under the MIT license, under the MIT license. CC BY-NC", "under the mit LICENSE under the mit",
    "The GNU General Public License, version 3, is a licence", "x cc by nc cc by nc 4 0 apache license version 2",
    "Ünder the mit license ünder", "work licensed under creative commons",
]


def texts():
    filler = "Lorem ipsum of the dolor and is sit to amet with this software "
    cut = [n[: len(n) // 2] for n in NOTICES]
    inside = [filler * (k % 4) + n + " " + filler * 2 for k, n in enumerate(NOTICES)]
    pairs = [a + " " + filler + b for a, b in zip(NOTICES, NOTICES[5:], strict=False)]
    changed = [" ".join(w for i, w in enumerate(n.split()) if i % 9 != 4) for n in NOTICES]
    return [*NOTICES, *cut, *inside, *pairs, *changed, *ODD, *ODD, filler * 30]


def found(spark, given, **more):
    frame = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    rows = licenses.scan(frame, **more).orderBy("doc_id").collect()
    return [(r.n_words, sorted((p["at"], p["label"]) for p in r.places), r.labels, r.score) for r in rows]


def test_against_plain_version(spark):
    assert found(spark, texts()) == brute(texts())


def test_every_notice_is_found_by_its_label(spark):
    for t, row in zip(licenses.TEMPLATES, found(spark, texts()), strict=False):
        assert t.label in row[2]


def test_long_text_with_many_notices(spark):
    given = [("word " * 50 + NOTICES[1] + " ") * 800, "the of and to software " * 60_000]
    assert found(spark, given) == brute(given)


@pytest.mark.parametrize("kept", [0, 1])
def test_empty_table_clashing_columns_repeated_rows(spark, kept):
    rows = [(1, NOTICES[0], 7, ["x"], 2.5, "w")] * 2 * kept
    wide = spark.createDataFrame(rows, "doc_id long, text string, n_words long, labels array<string>, score double, _words string")
    out = licenses.scan(wide)
    assert out.columns == [*wide.columns, "n_words_", "places", "notices", "labels_", "score_"]
    assert [(r.n_words, r.n_words_, r.labels_) for r in out.collect()] == [(7, 5, ["mit"])] * 2 * kept


def test_no_templates_leaves_the_phrases(spark):
    assert found(spark, ["Under the MIT License"], templates=()) == [(4, [(0, "mit")], ["mit"], 1.0)]
