"""Quality rules: ordered decision lists learned by sequential covering, as Spark expressions.

Statistics of a text are one built-in expression per row: its words, lines and hashed
8-word windows stay in arrays of that row, so nothing is shuffled.

The list is learned from labelled documents. Each rule starts empty and grows by the
condition ``statistic > t`` or ``statistic <= t`` with the largest information gain on two
thirds of the labelled rows still uncovered; it is then pruned to the prefix that does best
on the other third, and kept if precise enough. Rows it covers are put aside and the next
rule is grown. Each step is one aggregation over the binned statistics, which returns a
few counts for each statistic and bin. The result is a chain of ``when`` expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.shared import WORD, bound_to, written

WINDOW = 8
#: At most so many labelled documents, those of least hash, are learned from.
LABELLED_ROWS = 20_000
#: Candidate cuts for each statistic: so many quantiles of each class, and its extremes.
QUANTILES = 24
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.95
MIN_COVERED = 3

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


# --- statistics --------------------------------------------------------------------------


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more, as the union of their places."""

    def places(ordered: Column) -> Column:
        def repeats(x, i):
            same = lambda at: F.coalesce(F.get(ordered, at)["h"] == x["h"], F.lit(False))
            return same(i - 1) | same(i + 1)

        return F.sort_array(F.transform(F.filter(ordered, repeats), lambda x: x["i"]))

    ordered = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    union = F.aggregate(
        bound_to(ordered, places),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n")),
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(union["n"])


def _repeated_words(words: Column) -> Column:
    def windows(hashed: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(hashed) - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(WINDOW)]),
        )
        return bound_to(each, _covered)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, 0).otherwise(bound_to(hashed, windows))


def _count(text: Column, characters: str) -> Column:
    """Characters of a class: what is left when runs of the others are taken out."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def statistics(text: Column) -> Column:
    """A struct of counts; a null text counts as empty. Use it inside bound_to()."""
    text = F.coalesce(text, F.lit(""))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("dup"))

    def of(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
        return bound_to(
            bound_to(lines, of_lines),
            lambda at: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                _count(text, "#*$%&|<>").cast("long").alias("n_symbols"),
                at["dup"].cast("long").alias("n_dup_lines"),
                _repeated_words(words).cast("long").alias("n_repeat_words"),
                at["n"].cast("long").alias("n_lines"),
                _count(text, "A-Z").cast("long").alias("n_upper"),
                _count(text, "!?").cast("long").alias("n_exclaimed"),
                _count(text, "0-9").cast("long").alias("n_digits"),
            ),
        )

    return bound_to(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


def features(s: Column) -> dict[str, Column]:
    """What conditions may ask of a statistics struct, by name."""
    words, chars = F.greatest(s["n_words"], F.lit(1)), F.greatest(s["word_chars"], F.lit(1))
    return {
        "symbols a word": s["n_symbols"] / words,
        "exclamations a word": s["n_exclaimed"] / words,
        "capitals a character": s["n_upper"] / chars,
        "digits a character": s["n_digits"] / chars,
        "characters a word": s["word_chars"] / words,
        "repeated lines": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        "repeated words": s["n_repeat_words"] / words,
        "words a line": s["n_words"] / F.greatest(s["n_lines"], F.lit(1)),
        "words": s["n_words"].cast("double"),
    }


# --- decision list -----------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"

    def holds(self, values: dict[str, Column]) -> Column:
        return values[self.feature] > self.cut if self.above else values[self.feature] <= self.cut


@dataclass(frozen=True)
class DecisionList:
    """Rules that reject, tried in order; documents under none of them are kept."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def rejected_by(self, s: Column) -> Column:
        """The first rule that holds, as a string; null if none does."""
        values, out = features(s), F.lit(None).cast("string")
        for rule in reversed(self.rules):
            out = F.when(reduce(Column.__and__, (c.holds(values) for c in rule)), " and ".join(map(str, rule))).otherwise(out)
        return out


def labelled_statistics(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """``grow, bad`` and a column for each feature of at most ``rows`` labelled documents."""
    chosen = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("quality"))
        .filter("id is not null and quality is not null")
        .orderBy(F.xxhash64("id"), "id", "quality").limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    values = F.transform(F.array(statistics(F.col("text"))), lambda s: F.array(*features(s).values()))[0]
    return texts.join(F.broadcast(chosen), "id").select(
        (F.pmod(F.xxhash64("id", F.lit("grow")), F.lit(3)) > 0).alias("grow"),
        (F.col("quality") == 0).alias("bad"),
        values.alias("f"),
    )


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = LABELLED_ROWS) -> DecisionList:
    """The decision list for ``labels (doc_id, quality)``, quality 0 being what to reject.

    At most ``rows`` labelled documents are used, so the tables below are bounded and fit
    one task. Without labels of both classes the list is empty and rejects nothing.
    """
    names = FEATURES
    known = written(labelled_statistics(docs, labels, id_col, text_col, rows), "labelled").coalesce(1)
    places = [F.percentile_approx(F.col("f")[k], [i / QUANTILES for i in range(QUANTILES + 1)], 10_000).alias(f"q{k}") for k in range(len(names))]
    found = known.groupBy("bad").agg(*places).collect()
    if len(found) < 2:
        return DecisionList()
    cuts = []
    for k in range(len(names)):
        values = sorted({v for r in found for v in r[f"q{k}"]})
        cuts.append([(a + b) / 2 for a, b in zip(values, values[1:])])
    # a value's bin: how many cuts it exceeds
    exceeded = [F.filter(F.array(*map(F.lit, c)), partial(_below, F.col("f")[k])) if c else F.array() for k, c in enumerate(cuts)]
    binned = written(known.select("grow", "bad", *[F.size(e).alias(f"b{k}") for k, e in enumerate(exceeded)]), "binned").coalesce(1)
    return DecisionList(tuple(_cover(binned, names, cuts)))


def _below(value: Column, cut: Column) -> Column:
    return cut < value


#: The names that features() gives, in its order.
FEATURES = [
    "symbols a word", "exclamations a word", "capitals a character", "digits a character", "characters a word",
    "repeated lines", "repeated words", "words a line", "words",
]


def _cover(binned: DataFrame, names: list[str], cuts: list[list[float]]):
    """Rules one by one; each step is one aggregation of ``binned``."""
    rest = binned
    for _ in range(MAX_RULES):
        rule: list[tuple[int, bool, int]] = []  # feature, above, place of the cut
        while len(rule) < MAX_CONDITIONS:
            step = _best_condition(rest.filter("grow").filter(_all(rule)), cuts)
            if step is None:
                break
            rule.append(step)
        if not rule:
            return
        prefixes = [_all(rule[: i + 1]) for i in range(len(rule))]
        counts = rest.agg(*[
            F.count_if(p & (F.col("bad") == bad) & (F.col("grow") == grow)).alias(f"c{i}{bad:d}{grow:d}")
            for i, p in enumerate(prefixes) for bad in (True, False) for grow in (True, False)
        ]).first()
        worth = []
        for i in range(len(rule)):
            p, n = counts[f"c{i}10"], counts[f"c{i}00"]
            worth.append((p - n) / (p + n) if p + n else 0.0)
        length = worth.index(max(worth)) + 1 if any(worth) else len(rule)
        bad = counts[f"c{length - 1}11"] + counts[f"c{length - 1}10"]
        good = counts[f"c{length - 1}01"] + counts[f"c{length - 1}00"]
        if bad < MIN_COVERED or bad < MIN_PRECISION * (bad + good):
            return
        rule = rule[:length]
        yield tuple(Condition(names[f], above, cuts[f][at]) for f, above, at in rule)
        rest = rest.filter(~_all(rule))


def _all(rule: list[tuple[int, bool, int]]) -> Column:
    each = [F.col(f"b{f}") > at if above else F.col(f"b{f}") <= at for f, above, at in rule]
    return reduce(Column.__and__, each, F.lit(True))


def _best_condition(rows: DataFrame, cuts: list[list[float]]) -> tuple[int, bool, int] | None:
    """The condition of largest gain, or None if no bad row is left or none helps."""
    pairs = ", ".join(f"{f}, b{f}" for f in range(len(cuts)))
    counted = rows.select("bad", F.expr(f"stack({len(cuts)}, {pairs}) as (f, b)")).groupBy("f", "b", "bad").count().collect()
    table = [[[0, 0] for _ in range(len(c) + 1)] for c in cuts]
    for r in counted:
        table[r["f"]][r["b"]][r["bad"]] += r["count"]
    good0, bad0 = (sum(x[k] for x in table[0]) for k in (0, 1))
    if not good0 or not bad0:
        return None
    base = math.log2(bad0 / (bad0 + good0))
    best = (1e-9, 0)
    choice = None
    for f, of in enumerate(table):
        good = bad = 0
        for at in range(len(cuts[f])):
            good, bad = good + of[at][0], bad + of[at][1]
            for above, n, p in ((False, good, bad), (True, good0 - good, bad0 - bad)):
                if p and p + n < bad0 + good0:
                    gain = (p * (math.log2(p / (p + n)) - base), p)
                    if gain > best:
                        best, choice = gain, (f, above, at)
    return choice


# --- operator ----------------------------------------------------------------------------


def judged(text: Column, rules: DecisionList) -> Column:
    """Struct of the statistics, base_failed, kept and the rule that rejected (else null)."""

    def verdict(s: Column) -> Column:
        return bound_to(
            rules.rejected_by(s),
            lambda rule: F.struct(
                *[s[c].alias(c) for c in COUNTS],
                base_failed(s).alias("base_failed"),
                (~base_failed(s) & rule.isNull()).alias("kept"),
                rule.alias("rule"),
            ),
        )

    return bound_to(statistics(text), verdict)


def judge(docs: DataFrame, rules: DecisionList, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, counts, ``base_failed, kept, rule``.

    Null texts count as empty and fail the base rule. Repeated rows and null ids are
    judged row by row; other columns are ignored; an empty table gives an empty result.
    """
    return docs.select(F.col(id_col).alias("doc_id"), judged(F.col(text_col), rules).alias("j")).select("doc_id", "j.*")


def keep_good(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the base rule or the list rejects."""
    return docs.filter(bound_to(judged(F.col(text_col), rules), lambda j: j["kept"]))

