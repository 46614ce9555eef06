"""Text-line repair and positional CSV parsing, DataFrame → DataFrame.

A *lines* DataFrame has one row per physical text line of a report member:
``path, member, line_no, line`` (``line_no`` counts from 0 at the member's first
non-blank line; extra columns pass through). The functions here are plain Spark column
expressions, so parsing runs in the JVM next to the scan and never leaves codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions.clean import NA_TEXT, ads_value, amount_value, null_if_blank
from adtally.operators.partitioning import SPREAD_BYTES, spread

BOM = "\ufeff"
# Placed in empty unquoted fields before parsing so that a present-but-empty field can be
# told apart from a missing one (from_csv turns both into null). Removed afterwards. A
# record cannot hold this character itself, because it ends lines in every archive reader.
_MARK = "\r"
# The CSV parser refuses lines of more columns than 20,480; longer lines are cut here
# (their first fields and the status "long" stay the same).
_MAX_PIECES = 20_000

_CSV_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    # doubled quotes inside a quoted field are one literal quote
    "escape": '"',
    # keep "Rob "Chip" F, Jr" as one field instead of splitting at its comma
    "unescapedQuoteHandling": "STOP_AT_CLOSING_QUOTE",
    # a quoted empty field ("") must stay a present field; no parsed value can be two
    # markers, so nothing is turned into null by the parser itself
    "nullValue": _MARK * 2,
}

STATUSES = ("ok", "quote_stripped", "short", "long", "realigned")
RECORD_COLUMNS = ("page_id", "page_name", "disclaimer", "amount_spent", "number_of_ads")


@dataclass(frozen=True)
class Layout:
    """Positional column names of one source layout (header text is never used)."""

    name: str
    fields: tuple[str, ...]
    min_width: int
    max_width: int


# --- fixed values: column positions of the published report layouts --------------------
LAYOUTS = {
    "new": Layout("new", ("page_id", "page_name", "disclaimer", "amount_spent", "number_of_ads"), 5, 5),
    "old": Layout("old", ("page_name", "disclaimer", "amount_spent", "number_of_ads"), 4, 4),
    "regional": Layout(
        "regional",
        ("page_id", "page_name", "disclaimer", "amount_spent", "number_of_ads", "col6", "col7"),
        4,
        7,
    ),
}
# ---------------------------------------------------------------------------------------


def split_bom(df: DataFrame, line: str = "line") -> DataFrame:
    """Byte-order-mark repair: every U+FEFF ends a record.

    A mark at the start of a line simply vanishes, one in the middle splits the line into
    two records, and the empty pieces (blank lines included) are dropped. Adds ``piece``,
    the 0-based position of the record inside its physical line.
    """
    pieces = F.filter(F.split(F.col(line), BOM), lambda p: p != "")
    others = [F.col(c) for c in df.columns if c != line]
    return df.select(*others, F.posexplode(pieces).alias("piece", line))


def drop_header(df: DataFrame) -> DataFrame:
    """Remove the first record of each member, whatever it says (the header row)."""
    first = (F.col("line_no") == 0) & (F.coalesce(F.col("piece"), F.lit(0)) == 0)
    return df.filter(~first)


def _quote_count(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _parse_struct(line: Column, width: int) -> Column:
    """from_csv into ``width`` string fields, empty fields marked so they stay non-null."""
    schema = ", ".join(f"f{i} STRING" for i in range(width)) + ", _corrupt STRING"
    clean = F.substring_index(F.replace(line, F.lit(_MARK), F.lit("")), ",", _MAX_PIECES)
    # the regex runs only on the few lines that have an empty field at all
    has_empty = clean.contains(",,") | clean.startswith(",") | clean.endswith(",")
    marked = F.when(
        has_empty, F.regexp_replace(clean, r"(?<=^|,)(?=,|$)", _MARK)
    ).otherwise(clean)
    return F.from_csv(marked, schema, _CSV_OPTIONS)


def _width_sql(struct: str, width: int) -> str:
    # present fields form a prefix, so the count of non-null fields is the field count
    return " + ".join(f"IF({struct}.f{i} IS NULL, 0, 1)" for i in range(width))


def _field_sql(struct: str, i: int) -> str:
    # marker out; empty text and NA to null
    return f"nullif(nullif(replace({struct}.f{i}, char(13), ''), ''), '{NA_TEXT}')"


# A field of a line: quoted up to a closing quote that ends the field, or up to the comma.
_FIELD = r'(?:^|,)("(?:[^"]|"")*+"(?=,|$)|[^,]*+)'


def aligned_fields(text: Column, layout: Layout) -> Column:
    """The record of an over-wide line, read from both ends; null if its ends don't fit.

    The page id is the first field (where the layout has one) and must hold a digit; the
    amount and the number of ads are the last ones and must be numbers. What lies between is
    the page name and the disclaimer, with more commas than one. Each place for the comma
    that parts them has a cost: a part joined to the one before it costs 1 unless it starts
    with a blank, as text goes on after a comma, and a disclaimer that starts with a blank
    costs 1. The cheapest place counts, of equals the one with the shortest page name.
    """
    left = 1 if layout.fields[0] == "page_id" else 0
    right = 1 if layout.name == "regional" else 2

    def unquoted(f: Column) -> Column:
        inner = F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))
        return F.when((F.length(f) >= 2) & f.startswith('"') & f.endswith('"'), inner).otherwise(f)

    def record(fields: Column) -> Column:
        n = F.size(fields)
        parts = F.slice(fields, left + 1, F.greatest(n - left - right, F.lit(0)))
        of_end = lambda k: F.get(fields, n - k)

        def cost(cut: Column) -> Column:
            # parts before ``cut`` are the page name, the others the disclaimer
            joined = F.transform(parts, lambda p, i: F.when((i == 0) | (i == cut) | p.startswith(" "), 0).otherwise(1))
            apart = F.when(F.get(parts, cut).startswith(" "), 1).otherwise(0)
            return F.aggregate(joined, apart, lambda a, x: a + x)

        cuts = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda c: F.struct(cost(c).alias("cost"), c.alias("cut")))
        cut = F.array_min(cuts)["cut"]
        amount, ads = of_end(right), of_end(1)
        fits = (F.size(parts) >= 2) & amount_value(amount).isNotNull()
        if left:
            fits = fits & F.get(fields, F.lit(0)).rlike("[0-9]")
        if right == 2:
            fits = fits & (ads_value(ads).isNotNull() | (ads == "") | (ads == NA_TEXT))
        value = lambda c: null_if_blank(c)
        none = F.lit(None).cast("string")
        return F.when(
            fits,
            F.struct(
                (value(F.get(fields, F.lit(0))) if left else none).alias("page_id"),
                value(F.array_join(F.slice(parts, 1, cut), ",")).alias("page_name"),
                value(F.array_join(F.slice(parts, cut + 1, F.size(parts)), ",")).alias("disclaimer"),
                value(amount).alias("amount_spent"),
                (value(ads) if right == 2 else none).alias("number_of_ads"),
            ),
        )

    raw = F.regexp_extract_all(F.when(_quote_count(text) % 2 == 1, F.replace(text, F.lit('"'), F.lit(""))).otherwise(text), F.lit(_FIELD), F.lit(1))
    # the fields are found once and looked at many times
    return F.element_at(F.transform(F.array(F.transform(raw, unquoted)), record), 1)


def parse_lines(
    df: DataFrame,
    layout: str | Layout = "new",
    repair_quotes: bool = True,
    line: str = "line",
    realign: bool = False,
) -> DataFrame:
    """Tolerant positional CSV parse of single-line records.

    Adds ``page_id, page_name, disclaimer, amount_spent, number_of_ads`` (all strings;
    ``page_id`` null for the old layout, ``number_of_ads`` null when absent), ``n_fields``
    and ``status`` in ``ok | quote_stripped | short | long``; drops ``line``.

    Quote repair (``repair_quotes``): all straight double quotes are deleted from a line
    when their count is odd (an unmatched quote, often a straight quote paired with a
    curly one), or when the line has a wrong number of fields and deleting them makes the
    count right. Lines with too many fields keep their first fields; too few are padded
    with null. Empty text and ``NA`` become null.

    ``realign``: an over-wide line whose ends fit the layout (see ``aligned_fields``) gets
    status ``realigned`` and its surplus commas go to the text fields.

    Each from_csv sits in its own projection and is referenced by name afterwards, so it
    runs once per line; the repair parse runs only for lines that contain a quote.
    """
    lay = LAYOUTS[layout] if isinstance(layout, str) else layout
    # one field more than allowed so that "too long" is visible
    width = lay.max_width + 1
    lo, hi = lay.min_width, lay.max_width
    text = F.col(line)
    keep = [F.col(c) for c in df.columns if c != line]
    wraw = _width_sql("_raw", width)
    cols = [
        text.alias("_line"),
        _quote_count(text).alias("_nq"),
        _parse_struct(text, width).alias("_raw"),
        # later columns refer to earlier aliases of this select (lateral aliases); Spark
        # splits them into projections, so each from_csv still runs once per line
        F.expr(wraw).alias("_w_raw"),
    ]
    if repair_quotes:
        needs = f"_nq > 0 AND (_nq % 2 = 1 OR NOT (_w_raw BETWEEN {lo} AND {hi}))"
        stripped = F.replace(F.col("_line"), F.lit('"'), F.lit(""))
        cols += [
            F.when(F.expr(needs), _parse_struct(stripped, width)).alias("_str"),
            F.expr(
                f"({needs}) AND (_nq % 2 = 1 OR ({_width_sql('_str', width)}) BETWEEN {lo} AND {hi})"
            ).alias("_stripped"),
            F.expr("IF(_stripped, _str, _raw)").alias("_rec"),
            F.expr(f"IF(_stripped, {_width_sql('_str', width)}, _w_raw)").alias("n_fields"),
        ]
    else:
        cols += [
            F.col("_raw").alias("_rec"),
            F.col("_w_raw").alias("n_fields"),
            F.lit(False).alias("_stripped"),
        ]
    rec = df.select(*keep, *cols)

    status = (
        f"CASE WHEN n_fields < {lo} THEN 'short' WHEN n_fields > {hi} THEN 'long' "
        "WHEN _stripped THEN 'quote_stripped' ELSE 'ok' END"
    )
    fields = [
        F.expr(_field_sql("_rec", lay.fields.index(c)) if c in lay.fields else "CAST(NULL AS STRING)").alias(c)
        for c in RECORD_COLUMNS
    ]
    if not realign:
        return rec.select(*keep, *fields, "n_fields", F.expr(status).alias("status"))
    rec = rec.withColumn("_aligned", F.when(F.col("n_fields") > hi, aligned_fields(F.col("_line"), lay)))
    fits = F.col("_aligned").isNotNull()
    fields = [F.when(fits, F.col("_aligned")[c]).otherwise(f).alias(c) for c, f in zip(RECORD_COLUMNS, fields)]
    return rec.select(*keep, *fields, "n_fields", F.when(fits, "realigned").otherwise(F.expr(status)).alias("status"))


def parse_problems(parsed: DataFrame, keys: tuple[str, ...] = ("path", "member")) -> DataFrame:
    """Count of records per file and parse status (the reader's warnings, as data)."""
    return (
        parsed.withColumn("amount_invalid", amount_value("amount_spent").isNull())
        .groupBy(*keys, "status", "amount_invalid")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def spread_lines(
    df: DataFrame, partitions: int | None = None, min_bytes: int = SPREAD_BYTES
) -> DataFrame:
    """Spread lines over the cores by their position when the input has few partitions
    (see ``adtally.operators.partitioning.spread``): parsing is the costly per-line step."""
    return spread(df, "path", "member", "line_no", partitions=partitions, min_bytes=min_bytes)
