"""URL rules, segmentation and naive Bayes against plain Python."""

import itertools
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from adtally.llm import queries, url_filter

SCHEMA = "page_id long, url string, html string, host string, verdict int"
RULES = queries.URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_for(host, path):
    fits = []
    for rule, verdict in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme/", "http://", "http:///en/", "http://Example.COM/en/", "https://www.example.com/en/x", "http://example.com", "http://com/",
    "x://a.net/es/?q", "x://net/fr/#", "x://a.net/es", "x://b.example.com?/en/", "x://b.example.com#a://c.com/", "x://notexample.com/en/", "x://a.com:80/",
    "x://wwwexample.com/en/", "x://ÀB.com/ÀB", "a\nb://c.com/\nd?e", "x://redhouse.org/en/1", "x://" + "redhouse" * 400 + ".org/" + "a/" * 2000,
]


def rows(rng, n=300):
    hosts = ["www.example.com", "redhouse.example.com", "bluecar.net", "a.bluecar.net", "redcar.org", "spam-x.example.com"]
    out = [(i, u, "red house blue car the", "clash", 1) for i, u in enumerate(URLS)]
    for i in range(n):
        path = rng.choice(["/en/", "/fr/", "/es/", "/de/"]) + str(rng.randrange(100)) + rng.choice(["", ".html", "?a=b", "#top"])
        out.append((100 + i, f"http://{rng.choice(hosts)}{path}", " ".join(rng.choice(["red", "house", "blue", "car"]) for _ in range(20)), "", 0))
    return out + [out[3], (None, out[6][1], None, None, None)]


def test_rules_match_brute_force(spark):
    data = rows(random.Random(1))
    found = url_filter.judge(spark.createDataFrame(data, SCHEMA), RULES).collect()
    got, want = Counter(), Counter()
    for r in found:
        got[r.page_id, r.host, r.path, r.rule] += 1
        assert r.verdict in ("allow", "block")
        if r.rule:
            assert (r.rule, r.verdict) in RULES
        else:
            assert r.verdict == ("allow" if r.odds >= 0 else "block")
    for i, u, *_ in data:
        want[i, *split(u), rule_for(*split(u))[0]] += 1
    assert got == want


def test_model_matches_plain_bayes(spark):
    data = rows(random.Random(2))
    found = url_filter.judge(spark.createDataFrame(data, SCHEMA), RULES).collect()
    tokens = lambda r: [*(r.words or []), *("/" + ("0" if t[0].isnumeric() else t) for t in path_tokens(r.path))]
    counts, seen = {True: Counter(), False: Counter()}, Counter()
    for r in found:
        if r.rule:
            seen[dict(RULES)[r.rule] == "allow"] += 1
            counts[dict(RULES)[r.rule] == "allow"].update(tokens(r))
    used = len(set(counts[True]) | set(counts[False]))
    total = {k: sum(c.values()) for k, c in counts.items()}
    for r in found:
        odds = math.log((seen[True] + 1) / (seen[False] + 1))
        for t in tokens(r):
            odds += math.log((counts[True][t] + 1) / (total[True] + used)) - math.log((counts[False][t] + 1) / (total[False] + used))
        assert abs(odds - r.odds) < 1e-6 * max(1, abs(odds))


def path_tokens(path):
    import regex

    return regex.findall(r"\p{L}+|\p{N}+", path.lower())


def test_best_cut_is_the_most_probable():
    counts = {"red": 50, "house": 40, "redh": 1, "ouse": 1, "re": 5, "d": 3}
    total = 100.0
    assert url_filter.best_cut("redhouse", counts, total) == ["red", "house"]

    def worth(parts):
        return sum(math.log(counts[p] / total) if p in counts else math.log(10 / total) - len(p) * math.log(10) for p in parts)

    for name in ("redhouse", "dreouse", "xxred", "rehoused"):
        ways = []
        for cuts in itertools.product([0, 1], repeat=len(name) - 1):
            bounds = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(name)]
            ways.append([name[a:b] for a, b in zip(bounds, bounds[1:])])
        assert abs(worth(url_filter.best_cut(name, counts, total)) - max(map(worth, ways))) < 1e-9


def test_segments_learned_from_pages(spark):
    counts = url_filter.word_counts(spark.createDataFrame([("red house. Red car, blue house",), (None,), ("house red",)], "text string"))
    names = spark.createDataFrame([("redhouse",), ("bluecar",), ("zzz",)], "name string")
    found = {r.name: r.words for r in url_filter.segmented(names, counts).collect()}
    assert found["redhouse"] == ["red", "house"] and found["bluecar"] == ["blue", "car"] and "".join(found["zzz"]) == "zzz"


def test_empty_table_and_nothing_learned(spark):
    assert url_filter.judge(spark.createDataFrame([], SCHEMA), RULES).count() == 0
    found = url_filter.judge(spark.createDataFrame([(1, "x://a.org/", None, "", 0)], SCHEMA), RULES).select("verdict", F.col("rule")).collect()
    assert [(r.verdict, r.rule) for r in found] == [("allow", None)]


def test_words_of_any_length(spark):
    long, longer, other = "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzred", "abcdefghijklmnopqrstuvwxzz"
    counts = spark.createDataFrame([(long, 50), (longer, 2), (other, 9), ("red", 90), ("house", 40)], "word string, n long")
    names = spark.createDataFrame([(f"red{long}house",), (f"{longer}house",), ("q" * 60,), (f"{long[:25]}red",)], "name string")
    found = {r.name: r.words for r in url_filter.segmented(names, counts).collect()}
    known = {long: 50, longer: 2, "red": 90, "house": 40}
    assert found[f"red{long}house"] == ["red", long, "house"]
    assert found[f"{longer}house"] == plain_cut(f"{longer}house", known, 191)
    assert found["q" * 60] == ["q" * 60]
    assert found[f"{long[:25]}red"] == plain_cut(f"{long[:25]}red", known, 191)


def plain_cut(name, counts, total):
    """The best of all cuts, by trying each last word."""
    best = [(0.0, [])]
    for end in range(1, len(name) + 1):
        ways = []
        for start in range(end):
            n = counts.get(name[start:end])
            p = math.log(n / total) if n else math.log(10 / total) - (end - start) * math.log(10)
            ways.append((best[start][0] + p, [*best[start][1], name[start:end]]))
        best.append(max(ways, key=lambda w: w[0]))
    return best[-1][1]
