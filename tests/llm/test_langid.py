"""Language identification: learning, filters, held-out accuracy."""

import os
import random

import numpy as np
import pytest

from adtally.llm import langid, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score int, lang_pred string"
SYLLABLES = {"aa": ["ka", "ro", "mi", "tu"], "bb": ["schu", "ber", "ngt", "öl"], "cc": ["eau", "ion", "ère", "ka"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_learns_and_predicts(spark):
    rng = random.Random(1)
    known = [(i, text(rng, lang, 40), lang, 0, "") for i, lang in enumerate(list(SYLLABLES) * 30)]
    known += [(500, None, "aa", 0, ""), (501, "text", None, 0, ""), (502, "", "dd", 0, "")]
    filters = langid.learn(spark.createDataFrame(known, SCHEMA).select("lang", "text"))
    assert filters.languages == ("aa", "bb", "cc")
    asked = [(i, text(rng, lang, 30), lang, 1, "x") for i, lang in enumerate(list(SYLLABLES) * 20)]
    asked += [(900, None, "aa", 0, ""), (901, "", "", 0, ""), (902, "123 !?", "", 0, ""), (903, "q", "", 0, ""), asked[0], (None, asked[1][1], "", 0, "")]
    found = langid.identify(spark.createDataFrame(asked, SCHEMA), filters).collect()
    assert len(found) == len(asked)
    by_id = {r.doc_id: r for r in found}
    assert sum(by_id[i].lang_pred == lang for i, _, lang, *_ in asked[:60]) >= 58
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (900, 901, 902))
    assert by_id[903].lang_pred in filters.languages and by_id[None].lang_pred == by_id[1].lang_pred
    assert all(0 <= r.score <= 1 for r in found)


def test_trigrams_match_brute_force():
    texts = ["Ab cd", "", "é1é", "x", "a\0b", "straße  ÄÖ", "12 34", "😀ab"]
    ids, place = langid.trigrams(texts)
    want = []
    for i, t in enumerate(texts):
        s = "".join(c if c.isalpha() else " " for c in f" {t.lower()} ")
        want += [(i, s[k : k + 3]) for k in range(len(s) - 2) if sum(c != " " for c in s[k : k + 3]) >= 2]
    got = [(p, "".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0))) for g, p in zip(ids.tolist(), place.tolist())]
    assert sorted(got) == sorted(want)


def test_long_texts_are_cut_without_loss(monkeypatch):
    rng = random.Random(2)
    long = text(rng, "bb", 500)
    whole = np.sort(langid.trigrams([long])[0])
    monkeypatch.setattr(langid, "PIECE", 64)
    parts = [p for _, group in langid._pieces([(0, long)]) for p in group]
    inner = np.concatenate([langid.trigrams([p])[0] for p in parts])
    assert len(parts) > 10 and set(whole) <= set(inner)


def test_filters_hold_every_language_of_a_trigram():
    rng = np.random.default_rng(3)
    profiles = {f"l{k:03d}": rng.integers(0, 1 << 62, 2000) for k in range(70)}
    profiles["l001"] = np.concatenate([profiles["l001"], profiles["l000"][:100]])
    f = langid.Filters.build(profiles, "l000")
    slots = f.slots(profiles["l000"][:100])
    masks = f.rows[slots[0]] & f.rows[slots[1]] & f.rows[slots[2]] & f.rows[slots[3]]
    assert (masks[:, 0] & np.uint64(3) == 3).all() and f.rows.shape[1] == 2
    assert f.false_share.max() < 1e-3


def test_nothing_learned(spark):
    filters = langid.learn(spark.createDataFrame([], SCHEMA).select("lang", "text"))
    found = langid.identify(spark.createDataFrame([(1, "abc", "", 0, "")], SCHEMA), filters).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
    assert langid.identify(spark.createDataFrame([], SCHEMA), filters).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_held_out_accuracy(spark):
    found = queries.op9_bitmask_language(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.95
