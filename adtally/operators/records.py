"""Records over several lines: a quoted field may hold line breaks.

Whether a line starts a record follows from the number of quotes before it in its member: it
does if that number is even. The number is a prefix sum in two steps: running sums within
slices of a member, whose totals, a row a slice, are summed up over the member. So no task
reads a member whole, however long it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE_LINES = 10_000
MAX_LINES = 1_000


def join_records(lines: DataFrame, slice_lines: int = SLICE_LINES, max_lines: int = MAX_LINES) -> DataFrame:
    """``lines`` (``path, member, line_no, line``...) with the lines of a record joined by ``\\n``.

    A record has the ``line_no`` and the other columns of its first line. Quotes count as in
    plain CSV: a doubled quote within a field changes nothing, a quote left open reaches up to
    the next one. A record of more than ``max_lines`` lines is taken for one whose quote was
    never closed: its lines stay as they are, so nothing is lost and no task collects more.
    Lines of no member or numbered below 0 (unreadable archives) stay as they are.
    """
    of_member = ["path", "member"]
    known = F.col("member").isNotNull() & F.col("path").isNotNull() & (F.col("line_no") >= 0)
    rest, lines = lines.filter(~F.coalesce(known, F.lit(False))), lines.filter(known)
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    rows = lines.withColumns({"_odd": quotes % 2, "_slice": F.floor(F.col("line_no") / slice_lines)})
    within = Window.partitionBy(*of_member, "_slice").orderBy("line_no")
    rows = rows.withColumn("_before", F.coalesce(F.sum("_odd").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2)

    # a slice's last start depends on the parity that it begins with: both are kept
    last = lambda parity: F.max(F.when(F.col("_before") == parity, F.col("line_no")))
    slices = rows.groupBy(*of_member, "_slice").agg(F.sum("_odd").alias("_n"), last(0).alias("_last0"), last(1).alias("_last1"))
    earlier = Window.partitionBy(*of_member).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_in", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) % 2)
    slices = slices.withColumn("_last", F.when(F.col("_in") == 0, F.col("_last0")).otherwise(F.col("_last1")))
    slices = slices.withColumn("_open", F.last("_last", ignorenulls=True).over(earlier))

    rows = rows.join(slices.select(*of_member, "_slice", "_in", "_open"), [*of_member, "_slice"])
    starts = F.when((F.col("_before") + F.col("_in")) % 2 == 0, F.col("line_no"))
    start = F.coalesce(F.max(starts).over(within.rowsBetween(Window.unboundedPreceding, 0)), F.col("_open"), F.col("line_no"))
    rows = rows.withColumn("_record", start)
    long = rows.groupBy(*of_member, "_record").agg(F.count("*").alias("_lines")).filter(F.col("_lines") > max_lines)
    rows = rows.join(long, [*of_member, "_record"], "left")
    alone = F.col("_lines").isNotNull()
    # most lines are records of their own: only those of longer records are collected
    several = rows.withColumn("_many", ~alone & ((F.col("_record") != F.col("line_no")) | (F.col("_odd") == 1)))
    single = several.filter("NOT _many").select(*lines.columns)
    others = [c for c in lines.columns if c not in ("path", "member", "line", "line_no")]
    joined = several.filter("_many").groupBy(*of_member, "_record").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "line", *others))).alias("_all")
    )
    joined = joined.select(
        *of_member, F.col("_record").alias("line_no"), F.array_join(F.transform("_all", lambda x: x["line"]), "\n").alias("line"),
        *[F.col("_all")[0][c].alias(c) for c in others],
    )
    return single.unionByName(joined.select(*lines.columns)).unionByName(rest)
