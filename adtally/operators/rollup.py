"""Cleaning of parsed records and roll-ups to one row per advertiser (and region).

All roll-ups are a single ``groupBy().agg()``: Spark plans them as a partial
HashAggregate before the shuffle and a final one after, so a hot advertiser that holds a
large share of the rows is collapsed map-side and never lands whole on one reducer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions.clean import (
    ads_value,
    amount_value,
    is_censored,
    page_id_digits,
    round_to_long,
)

# --- fixed values: columns of the target tables ------------------------------------------
NATIONAL_COLUMNS = ("page_name", "disclaimer", "amt_spent", "num_of_ads", "page_id", "date")
REGIONAL_COLUMNS = ("page_name", "disclaimer", "amt_spent", "region", "page_id", "date")
# -----------------------------------------------------------------------------------------


def clean_records(df: DataFrame, clean_page_id: bool = True) -> DataFrame:
    """Numbers from the raw text fields.

    Adds ``amount`` and ``ads`` (double, null when not a number), ``amount_invalid`` and
    ``censored``; with ``clean_page_id`` the page id keeps only its digits.
    """
    cols = {
        "amount": amount_value("amount_spent"),
        "ads": ads_value("number_of_ads"),
        "censored": is_censored("amount_spent"),
    }
    if clean_page_id:
        cols["page_id"] = page_id_digits("page_id")
    out = df.withColumns(cols)
    return out.withColumn("amount_invalid", F.col("amount").isNull())


def zero_sum(c: Column | str) -> Column:
    """Sum that skips nulls and gives 0, not null, for a group without any value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(c), F.lit(0.0))


def national_rollup(df: DataFrame) -> DataFrame:
    """One row per page name, disclaimer, page id and date: spend and ad count.

    Used for the daily report and, with the archive date as ``date``, for the lifelong one.
    """
    return (
        df.groupBy("page_name", "disclaimer", "page_id", "date")
        .agg(
            round_to_long(zero_sum("amount")).alias("amt_spent"),
            round_to_long(zero_sum("ads")).alias("num_of_ads"),
        )
        .select(*NATIONAL_COLUMNS)
    )


def regional_rollup(df: DataFrame) -> DataFrame:
    """One row per page name, disclaimer, page id, date and region: spend only."""
    return (
        df.groupBy("page_name", "disclaimer", "page_id", "date", "region")
        .agg(round_to_long(zero_sum("amount")).alias("amt_spent"))
        .select(*REGIONAL_COLUMNS)
    )


#: An amount reported as "at most 100" lies between 0 and what is written.
BOUND_COLUMNS = ("spent_low", "spent_high", "n_censored", "n_records")


def censored_sums() -> list[Column]:
    """Aggregates of cleaned records: what censored amounts add, and how many there are."""
    return [
        F.sum(F.when(F.col("censored"), F.col("amount"))).alias("amount_censored"),
        F.sum(F.when(F.col("censored") & F.col("amount").isNotNull(), 1).otherwise(0)).alias("n_censored"),
    ]


def spend_bounds(df: DataFrame, regional: bool = False) -> DataFrame:
    """Lower and upper bound of the spend by target key, and the number of censored rows.

    ``df`` has sums (``amount``, ``amount_censored``, ``n_censored``, ``n_records``) of records
    or of groups of them. The target's own ``amt_spent`` is the upper bound.
    """
    keys = ["page_name", "disclaimer", "page_id", *(["region"] if regional else [])]
    high, censored = zero_sum("amount"), zero_sum("amount_censored")
    sums = {"spent_low": round_to_long(high - censored), "spent_high": round_to_long(high), "n_censored": F.sum("n_censored"), "n_records": F.sum("n_records")}
    return df.groupBy(*keys, "date").agg(*[c.alias(n) for n, c in sums.items()]).select(*keys, *BOUND_COLUMNS, "date")


def union_members(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column missing on one side is filled with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
