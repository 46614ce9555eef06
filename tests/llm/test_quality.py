"""Statistics against brute force; what the decision list learns."""

import random
import re
from collections import Counter

from adtally.llm import quality

SCHEMA = "doc_id long, text string, kept string, n_words int"
LABELS = "doc_id long, quality int, toxic int"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def texts(rng):
    out = [None, "", " \n\t", "a", "# | <b>", "x " * 19, "x " * 20, "é à b", "a\x0bb\x0cc\x1cd", "\n\n a\n a\n\n"]
    for _ in range(60):
        lines = [" ".join(rng.choice(["a", "bé", "c#", "😀", "dd,"]) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(12))]
        out.append("\n".join(rng.choice(lines or [""]) for _ in range(rng.randrange(20))))
    out.append(" ".join(f"w{i % 5000}" for i in range(30_000)))
    return out


def test_counts_match_brute_force(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts(random.Random(1)))]
    rows += [rows[5], (None, "a b c", None, None)]
    found = quality.judge(spark.createDataFrame(rows, SCHEMA), quality.DecisionList()).collect()
    got = sorted(((r.doc_id, *(r[c] for c in quality.COUNTS), r.base_failed, r.kept) for r in found), key=repr)
    want = sorted(((i, *brute(t), not brute(t)[-1]) for i, t, *_ in rows), key=repr)
    assert got == want


def labelled(rng, n=600):
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(30, 200))]
        bad = i % 4 == 0
        if bad and i % 8:
            words = [w + "###" for w in words]
        elif bad:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "", 0))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_learned_list_separates(spark):
    rows, labels = labelled(random.Random(2))
    labels += [(None, 0, 0), (5000, None, 1), (7000, 0, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    rules = quality.learn(docs, spark.createDataFrame(labels, LABELS))
    assert 1 <= len(rules.rules) <= quality.MAX_RULES
    found = {r.doc_id: r for r in quality.judge(docs, rules).collect()}
    for i, good, _ in labels[: len(rows)]:
        assert found[i].kept == bool(good), found[i]
        assert (found[i].rule is None) == bool(good)
    kept = quality.keep_good(docs, rules)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, good, _ in labels[: len(rows)] if good}
    # the same rows in another order give the same list
    assert quality.learn(docs.repartition(3), spark.createDataFrame(labels[::-1], LABELS)) == rules


def test_without_labels_nothing_is_rejected_by_rules(spark):
    rows, labels = labelled(random.Random(3), 40)
    docs = spark.createDataFrame(rows, SCHEMA)
    for some in ([], [x for x in labels if x[1]]):
        assert quality.learn(docs, spark.createDataFrame(some, LABELS)) == quality.DecisionList()
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.learn(empty, spark.createDataFrame(labels, LABELS)) == quality.DecisionList()
    assert quality.judge(empty, quality.DecisionList()).count() == 0


def test_judging_is_one_pass_without_python(spark):
    docs = spark.createDataFrame([(1, "a", "", 0)], SCHEMA)
    plan = quality.judge(docs, quality.DecisionList()).select("kept", "n_words")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("regexp_extract_all") == 1
