"""Day-by-day totals and day-over-day checks: which report dates look lost or inflated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def totals_by_date(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Total ads and spend per report date (and optional extra keys such as a kind).

    Regional reports have no number of ads: their total is null.
    """
    ads = F.sum("num_of_ads") if "num_of_ads" in df.columns else F.lit(None)
    return df.groupBy(*keys, "date").agg(
        ads.cast("bigint").alias("total_ads"),
        F.sum("amt_spent").cast("bigint").alias("total_spent"),
    )


def day_over_day(totals: DataFrame, threshold: float = 0.5, keys: tuple[str, ...] = ()) -> DataFrame:
    """Compare each date's totals with the previous date's.

    Adds ``prev_date``, ``prev_ads``, ``prev_spent``, the relative changes ``ads_change``
    and ``spent_change`` (null on the first date or when the previous total is 0) and
    ``flag``: ``drop`` or ``spike`` when a change passes ``threshold`` in either measure,
    else ``ok``. The input has one row per date (bounded by the calendar), so ordering
    within one window partition per key is cheap.
    """
    w = Window.partitionBy(*keys).orderBy("date")

    def change(cur: str, prev: str):
        return F.when(F.col(prev) != 0, (F.col(cur) - F.col(prev)) / F.col(prev))

    out = (
        totals.withColumn("prev_date", F.lag("date").over(w))
        .withColumn("prev_ads", F.lag("total_ads").over(w))
        .withColumn("prev_spent", F.lag("total_spent").over(w))
        .withColumn("ads_change", change("total_ads", "prev_ads"))
        .withColumn("spent_change", change("total_spent", "prev_spent"))
    )
    lo, hi = F.least("ads_change", "spent_change"), F.greatest("ads_change", "spent_change")
    flag = (
        F.when(lo <= -threshold, "drop").when(hi >= threshold, "spike").otherwise("ok")
    )
    return out.withColumn("flag", flag)


def _day(c: str):
    """Days since 1970 of a date column."""
    return F.unix_date(F.to_date(c))


def coverage_gaps(reports: DataFrame, days: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """The days between the first and the last report that no report covers, as runs.

    ``reports`` has a ``date`` for each report, the last of the ``days`` it covers; periods may
    overlap and repeat. Returns ``keys, gap_start, gap_end, gap_days``, a row a run. Periods
    are merged into islands by a running maximum of their ends; the rows of a key are its
    report dates, which the calendar bounds.
    """
    each = reports.select(*keys, _day("date").alias("end")).filter("end IS NOT NULL").distinct()
    each = each.withColumn("start", F.col("end") - (days - 1))
    before = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = each.withColumn("covered", F.max("end").over(before))
    text = lambda d: F.date_format(F.date_from_unix_date(d), "yyyy-MM-dd")
    return covered.filter(F.col("start") > F.col("covered") + 1).select(
        *keys, text(F.col("covered") + 1).alias("gap_start"), text(F.col("start") - 1).alias("gap_end"),
        (F.col("start") - F.col("covered") - 1).cast("bigint").alias("gap_days"),
    )


def period_reconcile(
    period: DataFrame, daily: DataFrame, days: int, keys: tuple[str, ...] = (), tolerance: float = 0.0
) -> DataFrame:
    """Totals of reports over ``days`` days held against the sums of the daily reports.

    Both have ``keys, date, total_spent``, a row a key and date; a period's ``date`` is its last
    day. Returns a row for each row of ``period``: ``total_spent, daily_spent, days_present,
    difference, flag``. ``flag`` is ``incomplete`` where a day has no daily report, ``differs``
    where the relative difference exceeds ``tolerance``, else ``ok``. The sums are a range
    frame over days, so a missing day shifts nothing.
    """
    both = daily.select(*keys, "date", F.lit(None).cast("bigint").alias("period"), F.col("total_spent").alias("day"), F.lit(0).alias("kind"))
    both = both.unionByName(period.select(*keys, "date", F.col("total_spent").alias("period"), F.lit(None).cast("bigint").alias("day"), F.lit(1).alias("kind")))
    w = Window.partitionBy(*keys).orderBy("_day").rangeBetween(-(days - 1), 0)
    rows = both.withColumn("_day", _day("date")).withColumns({
        "daily_spent": F.coalesce(F.sum("day").over(w), F.lit(0)),
        "days_present": F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).over(w),
    })
    off = F.abs(F.col("period") - F.col("daily_spent")) > tolerance * F.abs(F.col("daily_spent"))
    return rows.filter("kind = 1").select(
        *keys, "date", F.col("period").alias("total_spent"), "daily_spent", "days_present",
        (F.col("period") - F.col("daily_spent")).alias("difference"),
        F.when(F.col("days_present") < days, "incomplete").when(off, "differs").otherwise("ok").alias("flag"),
    )


def robust_spikes(
    totals: DataFrame, keys: tuple[str, ...] = (), history_days: int = 56, limit: float = 3.5, min_history: int = 3,
) -> DataFrame:
    """Drops and spikes against the same weekday's median, without a threshold set by hand.

    Adds ``n_history``, ``median``, ``deviation`` (median absolute deviation) over the dates of
    the same weekday within ``history_days`` before, ``score`` and ``flag``. The score is the
    distance from the median in robust standard deviations (1.4826 deviations); null with fewer
    than ``min_history`` dates, and where they are all equal: then any other value stands out.
    A frame holds at most a date a week.
    """  # noqa: D205
    w = Window.partitionBy(*keys, "_weekday").orderBy("_day").rangeBetween(-history_days, -1)
    rows = totals.withColumn("_day", _day("date")).withColumn("_weekday", F.weekday(F.to_date("date")))
    rows = rows.withColumn("_past", F.array_sort(F.filter(F.collect_list(F.col("total_spent").cast("double")).over(w), lambda x: x.isNotNull())))

    def middle(values):
        n = F.size(values)
        at = lambda i: F.get(values, i.cast("int"))
        return (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2

    rows = rows.withColumn("n_history", F.size("_past")).withColumn("median", middle(F.col("_past")))
    rows = rows.withColumn("_off", F.array_sort(F.transform("_past", lambda x: F.abs(x - F.col("median")))))
    rows = rows.withColumn("deviation", middle(F.col("_off")))
    off, enough = F.col("total_spent") - F.col("median"), F.col("n_history") >= min_history
    rows = rows.withColumn("score", F.when(enough & (F.col("deviation") > 0), off / (1.4826 * F.col("deviation"))))
    far = F.when(F.col("deviation") > 0, F.abs("score") > limit).otherwise(off != 0)
    flag = F.when(enough & far, F.when(off < 0, "drop").otherwise("spike")).otherwise("ok")
    return rows.withColumn("flag", flag).drop("_day", "_weekday", "_past", "_off")
