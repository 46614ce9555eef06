"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Documents are counted into cells, one for each combination of the margins' values (say
source, language, topic); from then on only the table of cells is worked on. Each cell has
a factor, at first 1. A round scales the factors so that the weighted tokens of each value
of the first margin meet their target, then those of the second, and so on; rounds go on
until all margins agree with their targets. A document is kept with a probability
proportional to its cell's factor, so the expected tokens of the sample have the target
shares in every margin. The factor that counts as 1 is the largest but for cells that hold
``CAPPED`` of all tokens at most; else a handful of documents of a rare value would decide
how little is kept of all others. What this cut takes is made good by raking again: cells at
probability 1 are held and the others raked, until the sample, as large as before, has the
target shares. Only a value whose documents are too few for its share, even if all are kept,
stays below it.

Only DataFrame operations are used. Documents are summed by cell before the shuffle, so a
source with a third of all rows costs one row a task. A step of a round is a windowed sum
over the cells of a value, and several rounds are one plan with one written table, so the
driver sees a job or two for each ``ROUNDS_A_PLAN`` rounds. Cells go back to the documents by
a join whose side Spark broadcasts only if it is small enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.shared import free_name, written

#: Rounds at most, and rounds in one plan.
ROUNDS = 105
ROUNDS_A_PLAN = 5
#: So many cells at most are raked in one task; more are dealt out by value for each step.
CELLS_A_TASK = 100_000
#: Largest relative distance of a value from its goal.
TOLERANCE = 1e-9
#: Share of tokens in cells whose probability may be cut to 1.
CAPPED = 0.05
SEED = 42
NONE = "(none)"


def goals(cells: DataFrame, margins: list[str], powers: dict[str, float], targets: dict[str, DataFrame]) -> DataFrame:
    """``margin, value, own, target``: tokens and target share of every value of every margin.

    Targets are given as a frame ``margin, target``, or else the shares of tokens raised to
    the margin's power and scaled to sum to 1: a power below 1 evens shares out. A value
    without a given target has 0.
    """
    values = F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("value"), "tokens") for m in margins])
    own = cells.select(F.explode(values).alias("v")).groupBy("v.margin", "v.value").agg(F.sum("v.tokens").alias("own"))
    power = F.coalesce(*[F.when(F.col("margin") == m, F.lit(float(powers[m]))) for m in margins if m not in targets], F.lit(1.0))
    own = own.withColumn("raised", F.when(F.col("own") > 0, F.pow(F.col("own").cast("double"), power)).otherwise(0.0))
    total = own.groupBy("margin").agg(F.sum("raised").alias("all"))
    shares = own.join(total, "margin").withColumn("share", F.when(F.col("all") > 0, F.col("raised") / F.col("all")).otherwise(0.0))
    for m, given in targets.items():
        given = given.select(F.lit(m).alias("margin"), F.col(m).alias("value"), F.col("target").cast("double").alias("given"))
        shares = shares.join(given, ["margin", "value"], "left")
        shares = shares.withColumn("share", F.when(F.col("margin") == m, F.coalesce("given", F.lit(0.0))).otherwise(F.col("share"))).drop("given")
    return written(shares.select("margin", "value", F.col("own").cast("double").alias("own"), F.col("share").alias("target")), "goals")


def with_goals(cells: DataFrame, margins: list[str], goals: DataFrame, goal: Column) -> DataFrame:
    """``cells`` with ``goal_<margin>``, the goal of the cell's value, for each margin."""
    for m in margins:
        own = goals.filter(F.col("margin") == m).select(F.col("value").alias(m), goal.alias(f"goal_{m}"))
        cells = cells.join(own, m)
    return cells


def _rounds(cells: DataFrame, margins: list[str], sums: dict[str, str], scale: str, off: str) -> DataFrame:
    """``cells`` after rounds that scale the factors of one margin after the other.

    ``scale`` and ``off``, a value's scale and its distance from the goal, are SQL over the
    cell's ``goal`` and the ``sums`` by value. A plan is one statement of ROUNDS_A_PLAN rounds;
    after each, the distances of its last round decide whether more follow. Goals that cells
    can't meet together (an empty combination) are approached as far as ROUNDS go. Whether
    one task does a plan or each step deals the cells out depends on their counted number.
    """
    kept = ", ".join(f"`{c}`" for c in cells.columns if c != "factor")
    offs = [f"off_{k}" for k in range(len(margins))]
    few = cells.count() <= CELLS_A_TASK
    query = "SELECT *, " + ", ".join(f"0D AS {c}" for c in offs) + " FROM {cells}"
    for _ in range(ROUNDS_A_PLAN):
        for k, m in enumerate(margins):
            summed = ", ".join(f"sum({v}) OVER (PARTITION BY `{m}`) AS {n}" for n, v in sums.items())
            query = f"SELECT *, `goal_{m}` AS goal, {summed} FROM ({query})"
            rest = ", ".join(c if c != offs[k] else f"{off} AS {c}" for c in offs)
            query = f"SELECT {kept}, factor * {scale} AS factor, {rest} FROM ({query})"
    for _ in range(ROUNDS // ROUNDS_A_PLAN):
        # the windows of a single partition need no exchange; the results are the same
        rows = written(cells.sparkSession.sql(query, cells=cells.coalesce(1) if few else cells), "cells")
        cells = rows.drop(*offs)
        if (rows.agg(F.max(F.array_max(F.array(*offs)))).first()[0] or 0.0) <= TOLERANCE:
            break
    return cells


def rake(cells: DataFrame, margins: list[str]) -> DataFrame:
    """``cells (margins..., tokens, factor, goal_...)`` with factors that meet the goals.

    A value with goal 0 gets factor 0.
    """
    scale = "CASE WHEN now > 0 THEN goal / now ELSE 1D END"
    return _rounds(cells, margins, {"now": "tokens * factor"}, scale, f"CASE WHEN factor > 0 THEN abs({scale} - 1) ELSE 0D END")


def rake_below_one(cells: DataFrame, margins: list[str]) -> DataFrame:
    """``cells`` with factors whose cut at 1 meets the goals.

    A step solves one margin with the cells at 1 held: a value's other cells are scaled to
    what is left of its goal, so a cell may come to 1 in one step and be freed in a later
    one.
    """
    sums = {
        "below": "CASE WHEN factor < 1 THEN factor * tokens ELSE 0D END",
        "held": "CAST(CASE WHEN factor < 1 THEN 0 ELSE tokens END AS DOUBLE)",
        "every": "factor * tokens",
    }
    scale = (
        "CASE WHEN below > 0 AND goal > held THEN (goal - held) / below"
        " WHEN (goal < held OR below > 0) AND every > 0 THEN goal / every ELSE 1D END"
    )
    return _rounds(cells, margins, sums, scale, "CASE WHEN goal > 0 THEN abs(below + held - goal) / goal ELSE 0D END")


def aims(goals: DataFrame, mass: float) -> Column:
    """The tokens to keep of each row of ``goals``: ``mass`` in all of a margin, none above its own.

    Values whose tokens are too few for their share are aimed at whole; the others share the
    rest in proportion to their targets. What comes to the driver is two sums a margin.
    """
    scales: dict[str, float] = {}
    scale, wider = F.lit(0.0), {r.margin: mass for r in goals.select("margin").distinct().collect()}
    while any(w > scales.get(m, 0.0) * (1 + TOLERANCE) for m, w in wider.items()):
        scales = {m: max(w, scales.get(m, 0.0)) for m, w in wider.items()}
        scale = F.coalesce(*[F.when(F.col("margin") == m, F.lit(s)) for m, s in scales.items()])
        short = F.col("target") * scale >= F.col("own")
        sums = goals.groupBy("margin").agg(
            F.sum(F.when(short, F.col("own")).otherwise(0.0)).alias("whole"), F.sum(F.when(short, 0.0).otherwise(F.col("target"))).alias("free")
        )
        wider = {r.margin: (mass - r.whole) / r.free if r.free else scales[r.margin] for r in sums.collect()}
    return F.least(F.col("target") * scale, F.col("own"))


def uniform(key: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from a row's key, the same in every run; null counts as a key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def mix(
    docs: DataFrame, margins: dict[str, Column], powers: dict[str, float], tokens: Column,
    id_col: str = "doc_id", targets: dict[str, DataFrame] | None = None, seed: int = SEED, capped: float = CAPPED,
) -> DataFrame:
    """``docs`` with ``probability`` and ``kept`` (named anew if taken), one row per row.

    ``margins`` and ``tokens`` are expressions over ``docs``. Null values of a margin form a
    value of their own, ``(none)``. Documents without tokens take their cell's probability.
    Equal ids are kept or left together. All shares within reach meet their targets. An
    empty table gives an empty result.
    """  # noqa: D205
    names = {m: free_name(docs, f"mix_{m}") for m in margins}
    values = {names[m]: F.coalesce(c.cast("string"), F.lit(NONE)) for m, c in margins.items()}
    columns, weights = list(values), free_name(docs, "mix_tokens")
    cells = docs.select(*[v.alias(n) for n, v in values.items()], tokens.cast("long").alias("tokens"))
    cells = written(cells.groupBy(*columns).agg(F.sum(F.coalesce("tokens", F.lit(0))).alias("tokens")), "cells")
    given = {names[m]: t.select(F.col(m).alias(names[m]), "target") for m, t in (targets or {}).items()}
    shares = goals(cells, columns, {names[m]: p for m, p in powers.items()}, given)
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    start = with_goals(cells.withColumn("factor", F.lit(1.0)), columns, shares, F.col("target") * F.lit(total))
    fitted = rake(start, columns).select(*columns, "tokens", "factor")
    top = fitted.agg(F.percentile("factor", 1 - capped, F.col("tokens"))).first()[0] or 1.0
    fitted = fitted.withColumn("factor", F.col("factor") / F.lit(top))
    mass = float(fitted.agg(F.sum(F.least("factor", F.lit(1.0)) * F.col("tokens"))).first()[0] or 0) if capped else 0.0
    if mass:
        fitted = rake_below_one(with_goals(fitted, columns, shares, aims(shares, mass)), columns)
    chance, kept = free_name(docs, "probability"), free_name(docs, "kept")
    known = fitted.select(*columns, F.round(F.least("factor", F.lit(1.0)), 6).alias(chance))
    rows = docs.withColumns({**values, weights: tokens.cast("long")}).join(known, columns)
    return rows.withColumn(kept, uniform(F.col(id_col), seed) < F.col(chance)).select(
        *docs.columns, *columns, weights, chance, kept
    )
