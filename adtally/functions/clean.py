"""Column-level cleaning rules for ad-spend report fields.

Every function takes and returns a :class:`pyspark.sql.Column`; nothing here touches
I/O or Python per row, so all of it runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the published report conventions) -----------------------
# Report date embedded in archive and member file names.
REPORT_DATE_PATTERN = r"20[12][0-9]-[0-9]{2}-[0-9]{2}"
# Characters that precede a censored amount such as "≤100" or "<= 100".
CENSORED_PATTERN = r"^[^0-9]*[≤<]"
# Text that the reports use for a missing value.
NA_TEXT = "NA"
# What page ids and amounts lose: all but digits; anything before the first digit.
NOT_DIGIT_PATTERN = "[^0-9]"
AMOUNT_PREFIX_PATTERN = "^[^0-9]+"
# --------------------------------------------------------------------------------------

# A plain decimal number with optional sign and exponent, padded by blanks. Spark's cast
# alone would accept "12d" or "1f" (Java type suffixes); R's as.numeric would not.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_blank(c: Column | str) -> Column:
    """Empty text and the literal ``NA`` become null (a deleted page has no name)."""
    c = _col(c)
    return F.when((c == "") | (c == NA_TEXT), F.lit(None).cast("string")).otherwise(c)


def page_id_digits(c: Column | str) -> Column:
    """Keep only the digits of a page id (``id:24`` → ``24``)."""
    return F.regexp_replace(_col(c), NOT_DIGIT_PATTERN, "")


def strip_amount_prefix(c: Column | str) -> Column:
    """Drop everything before the first digit: ``≤100`` → ``100``, ``$250`` → ``250``."""
    return F.regexp_replace(_col(c), AMOUNT_PREFIX_PATTERN, "")


def lenient_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number gives null, never an error.

    A number beyond a bigint, which the targets could not hold, is not a number either.
    """
    c = _col(c)
    number = F.trim(c).try_cast("double")
    return F.when(c.rlike(NUMBER_PATTERN) & (F.abs(number) < float(1 << 63)), number)


def amount_value(raw: Column | str) -> Column:
    """Spend amount as double, null when the field does not hold a number (``1,234``)."""
    return lenient_number(strip_amount_prefix(raw))


def ads_value(raw: Column | str) -> Column:
    """Number of ads as double, null when not a number. No prefix is stripped."""
    return lenient_number(raw)


def is_censored(raw: Column | str) -> Column:
    """True when the amount was reported as "at most 100" rather than an exact value."""
    return F.coalesce(_col(raw).rlike(CENSORED_PATTERN), F.lit(False))


def report_date(name: Column | str) -> Column:
    """``yyyy-MM-dd`` found in a file name, or null when the name carries no date."""
    return F.nullif(F.regexp_extract(_col(name), REPORT_DATE_PATTERN, 0), F.lit(""))


def base_name(path: Column | str) -> Column:
    """Last segment of a path or URI (a plain string split, no regex)."""
    return F.substring_index(_col(path), "/", -1)


def region_from_name(name: Column | str, label: str) -> Column:
    """Region between ``<label>_`` and ``.csv`` in a member name; null when absent."""
    pattern = "(?<=" + label + "_).+(?=\\.csv$)"
    return F.nullif(F.regexp_extract(base_name(name), pattern, 0), F.lit(""))


def period_start(date: Column | str, days: int | Column) -> Column:
    """First day covered by a report whose inclusive last day is ``date``."""
    return F.date_format(F.date_sub(F.to_date(_col(date)), days - 1), "yyyy-MM-dd")


def round_to_long(c: Column | str) -> Column:
    """Whole number for integer target columns (the SQL store rounded on insert).

    Null for a sum that no bigint holds; a load never fails on a number.
    """
    return F.round(_col(c)).try_cast("bigint")
