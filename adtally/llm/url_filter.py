"""URL filters: listed rules first, then naive Bayes over segmented host names and paths.

Names in a host are often words written together. A unigram model, counted over the words
of all pages, splits them: of all ways to cut a name, the Viterbi path with the largest
product of word probabilities. Only distinct names are segmented: each is exploded into its
substrings, which meet the word counts in a join, so no vocabulary is ever broadcast.

The words of the host and of the path are the tokens of a multinomial naive Bayes model.
It learns from the urls that a rule decides and judges the rest. Tokens are hashed into
``BUCKETS`` buckets, so the model has a fixed size whatever the corpus is.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.shared import python_ready, written

#: Longer words are looked up by so many letters at their head.
HEAD = 24
BUCKETS = 1 << 18
ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rules = list[tuple[str, str]]


# --- rules -------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null.

    A rule is a host and a path written together, ``example.com/en/``. It fits its host and
    all subdomains where the url's path starts with the rule's.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


# --- segmentation ------------------------------------------------------------------------


def names_in(text: Column) -> Column:
    """Runs of letters."""
    return F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over the runs of letters, lower-cased, of ``texts (text)``."""
    words = texts.select(F.explode(names_in(F.lower("text"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def best_cut(name: str, counts: dict[str, int], total: float) -> list[str]:
    """Words of the most probable cut; of equally probable ones, that with the longest last word.

    A substring that is no known word counts as a word seen ``10 / 10 ** length`` times,
    never more than a known one. So of all starts of an unknown last word only the best so
    far is kept, and known ones are tried by the lengths there are.
    """
    lengths = sorted({len(w) for w in counts})
    best: list[tuple[float, int]] = [(0.0, 0)]
    unknown = (0.0, 0)
    for end in range(1, len(name) + 1):
        # the odds of an unknown word are a product by letters, so those up to its start may be taken back
        unknown = max(unknown, (best[-1][0] + (end - 1) * math.log(10), end - 1), key=lambda w: w[0])
        ways = [(unknown[0] + math.log(10 / total) - end * math.log(10), unknown[1])]
        for length in lengths:
            if length > end:
                break
            if n := counts.get(name[end - length : end]):
                ways.append((best[end - length][0] + math.log(n / total), end - length))
        best.append(max(ways, key=lambda w: (w[0], -w[1])))
    out, end = [], len(name)
    while end:
        start = best[end][1]
        out.append(name[start:end])
        end = start
    return out[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, words`` for distinct ``names (name)``, by the unigram model ``counts (word, n)``."""
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    long = F.length("name")
    starts = names.select("name", F.explode(F.sequence(F.lit(1), long)).alias("start"))
    word = F.substring(F.col("name"), F.col("start"), F.col("length")).alias("word")
    lengths = F.sequence(F.lit(1), F.least(F.lit(HEAD), long - F.col("start") + 1))
    parts = starts.select("name", "start", F.explode(lengths).alias("length")).select("name", word)
    # of longer pieces, those of a length that a word with the same head has
    longer = counts.filter(F.length("word") > HEAD).select(F.left("word", F.lit(HEAD)).alias("head"), F.length("word").alias("length"))
    heads = starts.withColumn("head", F.substring(F.col("name"), F.col("start"), F.lit(HEAD)))
    reach = F.col("start") + F.col("length") - 1 <= long
    parts = parts.unionByName(heads.join(longer.distinct(), "head").filter(reach).select("name", word))
    known = parts.distinct().join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    @F.pandas_udf("array<string>")
    def cut(name: pd.Series, known: pd.Series) -> pd.Series:
        lists = ([] if k is None else k for k in known)
        return pd.Series([best_cut(x, {w["word"]: w["n"] for w in k}, total) for x, k in zip(name, lists)])

    return names.join(known, "name", "left").select("name", cut("name", "known").alias("words"))


# --- naive Bayes -------------------------------------------------------------------------


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def bayes_weights(known: DataFrame) -> tuple[float, np.ndarray]:
    """(prior, weight of each bucket): log odds of allow, from ``known (allow, buckets, n)``.

    ``n`` is how often a list of buckets occurs. Add-one smoothing over the buckets in use.
    At most two counts a bucket come to the driver.
    """
    seen = known.groupBy("allow").agg(F.sum("n").alias("n")).collect()
    rows = {r.allow: r.n for r in seen}
    each = known.select("allow", "n", F.explode("buckets").alias("bucket"))
    counts = np.zeros((2, BUCKETS))
    for r in each.groupBy("allow", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[int(r.allow), r.bucket] = r.n
    used = max(int((counts.sum(axis=0) > 0).sum()), 1)
    log = np.log(counts + 1) - np.log(counts.sum(axis=1, keepdims=True) + used)
    return math.log((rows.get(True, 0) + 1) / (rows.get(False, 0) + 1)), log[1] - log[0]


# --- operator ----------------------------------------------------------------------------


def judge(pages: DataFrame, rules: Rules, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """One row per row: ``page_id, host, path, rule, verdict, words, odds``.

    ``rule`` is null where the model decides; ``odds`` are its log odds of allow (allow from
    0 up, also where nothing was learned), computed for every row. Null urls, and urls
    without ``://``, have empty host and path, and the prior decides. Repeated rows and
    null ids stay; other columns are ignored; an empty table gives an empty result.
    """
    spark = python_ready(pages)
    counts = written(word_counts(pages.select(F.col(text_col).cast("string").alias("text"))), "words")
    rows = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    ).withColumn("by_rule", rule_of(F.col("host"), F.col("path"), rules))

    hosts = rows.groupBy("host").count().select("host")
    named = hosts.select("host", F.posexplode(names_in(F.col("host"))).alias("at", "name"))
    words = segmented(named.select("name").distinct(), counts)
    of_host = named.join(words, "name").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("w"))
    of_host = written(of_host.select("host", F.flatten(F.col("w.words")).alias("words")), "hosts")

    path_words = F.transform(
        F.regexp_extract_all(F.lower("path"), F.lit(r"\p{L}+|\p{N}+"), F.lit(0)),
        lambda t: F.concat(F.lit("/"), F.when(t.rlike(r"^\p{N}"), "0").otherwise(t)),
    )
    tokens = F.concat(F.coalesce("words", F.array().cast("array<string>")), path_words)
    full = rows.join(of_host, "host", "left").select(
        "page_id", "host", "path", "by_rule", "words", F.transform(tokens, _bucket).alias("buckets")
    )
    full = written(full, "judged_urls")
    known = full.filter("by_rule is not null").groupBy((F.col("by_rule.verdict") == ALLOW).alias("allow"), "buckets")
    prior, weights = bayes_weights(known.agg(F.count(F.lit(1)).alias("n")))
    model = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def odds(buckets: pd.Series) -> pd.Series:
        return pd.Series([prior + float(model.value[b].sum()) if len(b) else prior for b in buckets], dtype="float64")

    by_model = F.when(F.col("odds") >= 0, ALLOW).otherwise(BLOCK)
    return full.withColumn("odds", odds("buckets")).select(
        "page_id", "host", "path", F.col("by_rule.rule").alias("rule"),
        F.coalesce(F.col("by_rule.verdict"), by_model).alias("verdict"), "words", "odds",
    )
