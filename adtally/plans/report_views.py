"""Report-shaped views of general tables, sent through the same report functions.

These turn ordinary tables (an event log, orders with suppliers, customers, documents)
into advertiser records, text lines and file names, so every operator of the library can
be run, timed and checked against an independent SQL statement over whole tables. Every
view is a plain projection of its source; defects (unmatched quotes, byte-order marks,
short and long rows, invalid amounts) are placed by fixed rules on the row keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.operators.partitioning import spread
from adtally.plans.kinds import REPORT_PREFIX as _PREFIX

BOM = "\ufeff"


# Row keys of the source tables: used to spread a table that arrives in fewer partitions
# than there are cores (one small file) before the per-row work of a view.
_KEYS = {
    "events": ("event_id",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "customer": ("c_custkey",),
    "documents": ("doc_id",),
    "conversations": ("conv_id", "turn"),
}


# Declared schemas of the tables the views read: no inference job per read.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    df = reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, *_KEYS[name]) if name in _KEYS else df


def csv_line(*cols: Column) -> Column:
    """Comma-joined fields; a null field stays an empty field (no shift)."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def _text(c: Column) -> Column:
    return c.cast("string")


# --- events as advertiser records --------------------------------------------------------


def event_records(spark: SparkSession, sf_dir: str, shift_days: int = 0) -> DataFrame:
    """One advertiser record per event; ``shift_days`` moves the dates.

    page = user, disclaimer = event type (every 7th event with a straight and a curly
    quote), date = event day, region = ``R`` + event id mod 5, amount ``≤100`` for values
    up to 20 else the whole value, ads = event id mod 4.
    """
    e = table(spark, sf_dir, "events")
    disclaimer = F.when(
        F.col("event_id") % 7 == 0,
        F.concat(F.lit('Friends of "'), F.col("event_type"), F.lit("” PAC")),
    ).otherwise(F.col("event_type"))
    amount = F.when(F.col("value") <= 20, F.lit("≤100")).otherwise(
        _text(F.floor("value").cast("bigint"))
    )
    return e.select(
        "event_id",
        _text(F.col("user_id")).alias("page_id"),
        F.concat(F.lit("page "), _text(F.col("user_id"))).alias("page_name"),
        disclaimer.alias("disclaimer"),
        amount.alias("amount_spent"),
        _text(F.col("event_id") % 4).alias("number_of_ads"),
        F.date_add(F.to_date("ts"), shift_days).cast("string").alias("date"),
        F.concat(F.lit("R"), _text(F.col("event_id") % 5)).alias("region"),
    )


def event_lines(
    spark: SparkSession, sf_dir: str, label: str, regional: bool | None, shift_days: int = 0
) -> DataFrame:
    """Events as member lines of report archives (one archive per day).

    ``regional`` None gives each event twice, in the national and in its regional member.
    Every 500th line starts with a byte-order mark, like older published reports.
    """
    r = event_records(spark, sf_dir, shift_days)
    archive = F.concat(F.lit(f"{_PREFIX}_"), F.col("date"), F.lit(f"_US_{label}.zip"))
    bom = F.when(F.col("event_id") % 500 == 0, F.lit(BOM)).otherwise(F.lit(""))

    def row(member: Column, fields: list[str]) -> Column:
        line = F.concat(bom, csv_line(*[F.col(c) for c in fields]))
        return F.struct(member.alias("member"), line.alias("line"))

    fields = ["page_id", "page_name", "disclaimer", "amount_spent"]
    in_region = F.concat(
        F.lit(f"regions/{_PREFIX}_"), F.col("date"), F.lit(f"_US_{label}_"),
        F.col("region"), F.lit(".csv"),
    )
    in_nation = F.concat(F.lit(f"{_PREFIX}_"), F.col("date"), F.lit(f"_US_{label}_advertisers.csv"))
    rows = {True: row(in_region, fields), False: row(in_nation, [*fields, "number_of_ads"])}
    each = F.explode(F.array(*rows.values())) if regional is None else rows[regional]
    return r.select(
        archive.alias("path"), (F.col("event_id") + 1).alias("line_no"), each.alias("r")
    ).select("path", "r.member", "line_no", "r.line")


NATIONAL_HEADER = "Page ID,Page name,Disclaimer,Amount spent (USD),Number of ads in Library"
REGIONAL_HEADER = "Page ID,Page name,Disclaimer,Amount spent (USD)"


def header_of(member: str) -> str | None:
    """The header line of a report member; other members have none."""
    if not member.endswith(".csv"):
        return None
    return REGIONAL_HEADER if member.startswith("regions/") else NATIONAL_HEADER


def blank_lines(lines: DataFrame) -> DataFrame:
    """One blank line for each member of ``lines``: reports that have a header only."""
    return lines.select("path", "member").distinct().select("path", "member", F.lit(1).cast("bigint").alias("line_no"), F.lit("").alias("line"))


def downloaded_again(lines: DataFrame) -> DataFrame:
    """The same archives under names of their own, as a second download gets them."""
    return lines.withColumn("path", F.concat(F.lit("again "), F.col("path")))


#: A member that a load must ignore.
NOTES = {"regions/readme.txt": "0,note,note,9,9\n"}


# --- orders with suppliers as a lifelong report --------------------------------------------


# Ship dates are moved 28 years forward (10,227 days: same weekdays and leap days) so that
# they fall in the range of report dates; each ship month is one lifelong report.
SHIFT_DAYS = 10_227


def lineitem_lines(spark: SparkSession, sf_dir: str, shift_days: int = SHIFT_DAYS) -> DataFrame:
    """Line items joined to their supplier as lines of monthly lifelong reports.

    page = supplier (name, dirty id ``id:<suppkey>``), disclaimer from return flag and
    line status, amount = whole extended price, ads = whole quantity; the report date is
    the first day of the (shifted) ship month.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    joined = li.join(s, li.l_suppkey == s.s_suppkey, "inner")
    text = csv_line(
        F.concat(F.lit("id:"), _text(F.col("l_suppkey"))),
        F.col("s_name"),
        F.concat(F.lit("Paid by "), F.col("l_returnflag"), F.col("l_linestatus")),
        _text(F.floor("l_extendedprice").cast("bigint")),
        _text(F.floor("l_quantity").cast("bigint")),
    )
    shifted = F.date_add(F.to_date("l_shipdate"), shift_days)
    date = F.trunc(shifted, "month").cast("string")
    return joined.select(
        F.concat(F.lit(f"{_PREFIX}_"), date, F.lit("_US_lifelong.zip")).alias("path"),
        F.concat(F.lit(f"{_PREFIX}_"), date, F.lit("_US_lifelong_advertisers.csv")).alias("member"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_no"),
        text.alias("line"),
    )


def lifelong_pair(lines: DataFrame) -> DataFrame:
    """Two candidate members per lifelong archive: the lines in the first by name, and the
    same lines with another amount in the second, which a load must not read."""
    first = F.struct(F.replace("member", F.lit(f"{_PREFIX}_"), F.lit(f"{_PREFIX}Revamp_")).alias("member"), F.col("line"))
    second = F.struct(F.col("member"), F.concat("line", F.lit("0")).alias("line"))
    return lines.select("path", "line_no", F.explode(F.array(first, second)).alias("m")).select("path", "m.member", "line_no", "m.line")


# --- customers as damaged CSV lines ---------------------------------------------------------


def customer_lines(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Customers as CSV lines with defects placed by the customer key.

    ``tolerant``: key mod 4 = 0 a straight quote against a curly one, 1 an open quote,
    2 a quoted comma, 3 doubled quotes. ``widths``: 4 fields for even keys, 5 for odd.
    ``problems``: key mod 5 = 0 short, 1 long, 2 open quote, 3 amount with a thousands
    comma, 4 clean; one member per market segment. ``wide``: key mod 6 = 0 clean, 1 a comma
    in the name, 2 two in the disclaimer, 3 commas in both, 4 a comma in the disclaimer beside
    a quoted name with one, 5 an extra field at the end that is no number.
    """
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    key, name, seg = _text(k), F.col("c_name"), F.col("c_mktsegment")
    acct = _text(F.floor("c_acctbal").cast("bigint"))
    ads = _text(F.col("c_nationkey"))
    if mode == "tolerant":
        m = k % 4
        disc = (
            F.when(m == 0, F.concat(F.lit('Friends of "'), seg, F.lit("” Fund")))
            .when(m == 1, F.concat(F.lit('"Open '), seg))
            .when(m == 2, F.concat(F.lit('"'), seg, F.lit(', Inc"')))
            .otherwise(F.concat(F.lit('"Say ""'), seg, F.lit('"", now"')))
        )
        line = F.concat_ws(",", key, name, disc, acct, ads)
    elif mode == "widths":
        line = F.when(k % 2 == 0, F.concat_ws(",", key, name, seg, acct)).otherwise(
            F.concat_ws(",", key, name, seg, acct, ads)
        )
    elif mode == "strict":
        # 4 to 7 fields, read without quote repair: a quote left open swallows the rest
        disc = F.when(k % 9 == 0, F.concat(F.lit('"Open '), seg)).otherwise(seg)
        extra = [F.when(k % 4 >= n, F.lit(f"x{n}")) for n in (1, 2, 3)]
        line = F.concat_ws(",", key, name, disc, acct, *extra)
    elif mode == "old":
        line = F.concat_ws(",", name, F.concat(F.lit('"'), seg, F.lit(', Inc"')), acct, ads)
    elif mode == "problems":
        m = k % 5
        line = (
            F.when(m == 0, F.concat_ws(",", key, name, seg))
            .when(m == 1, F.concat_ws(",", key, name, seg, acct, ads, F.lit("extra")))
            .when(m == 2, F.concat_ws(",", key, name, F.concat(F.lit('"Open '), seg), acct, ads))
            .when(m == 3, F.concat_ws(",", key, name, seg, F.concat(F.lit('"'), acct, F.lit(',000"')), ads))
            .otherwise(F.concat_ws(",", key, name, seg, acct, ads))
        )
    elif mode == "wide":
        m = k % 6
        fund, pac = F.concat(seg, F.lit(", a fund, Inc")), F.concat(seg, F.lit(", PAC"))
        line = (
            F.when(m == 0, F.concat_ws(",", key, name, seg, acct, ads))
            .when(m == 1, F.concat_ws(",", key, F.concat(name, F.lit(", Inc")), seg, acct, ads))
            .when(m == 2, F.concat_ws(",", key, name, fund, acct, ads))
            .when(m == 3, F.concat_ws(",", key, F.concat(name, F.lit(", Ltd")), pac, acct, ads))
            .when(m == 4, F.concat_ws(",", key, F.concat(F.lit('"'), name, F.lit(',Co"')), pac, acct, ads))
            .otherwise(F.concat_ws(",", key, name, seg, acct, ads, F.lit("extra")))
        )
    else:
        raise ValueError(mode)
    return c.select(
        F.lit("customers.zip").alias("path"),
        seg.alias("member"),
        (k + 1).alias("line_no"),
        line.alias("line"),
    )


def customer_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as physical lines: key mod 3 = 1 a break in the disclaimer, 2 two breaks in the name.

    A record has four line numbers of its own, so the lines of a market segment keep its order.
    """
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 3 == 2, F.concat(F.lit('"'), F.col("c_name"), F.lit('\n""and"" others,\nInc"'))).otherwise(F.col("c_name"))
    disc = F.when(k % 3 == 1, F.concat(F.lit('"Paid by\n'), F.col("c_mktsegment"), F.lit('"'))).otherwise(F.col("c_mktsegment"))
    record = F.concat_ws(",", _text(k), name, disc, _text(F.floor("c_acctbal").cast("bigint")), _text(F.col("c_nationkey")))
    return c.select(
        F.lit("customers.zip").alias("path"), F.col("c_mktsegment").alias("member"), k, F.posexplode(F.split(record, "\n"))
    ).select("path", "member", (k * 4 + F.col("pos")).alias("line_no"), F.col("col").alias("line"))


# --- amounts as published text ----------------------------------------------------------------


def event_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values written the ways report amounts appear, chosen by event id mod 6."""
    e = table(spark, sf_dir, "events")
    whole = _text(F.floor("value").cast("bigint"))
    m = F.col("event_id") % 6
    raw = (
        F.when(m == 0, F.when(F.col("value") <= 20, F.lit("≤100")).otherwise(whole))
        .when(m == 1, F.concat(F.lit("$"), whole))
        .when(m == 2, F.lit("<= 100"))
        .when(m == 3, F.concat(whole, F.lit("d")))
        .when(m == 4, F.concat(whole, F.lit(",000")))
        .otherwise(F.concat(F.lit("-"), whole))
    )
    return e.select("event_id", raw.alias("raw"))


def event_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lines of daily reports with amounts that are no bigint, by event id mod 11:
    0 and 1 far too large, 2 no number; users divisible by 7 have no valid amount at all."""
    r = event_records(spark, sf_dir)
    m = F.col("event_id") % 11
    amount = (
        F.when((m == 0) | (F.col("page_id").cast("bigint") % 7 == 0), F.lit("9" * 23))
        .when(m == 1, F.lit("1e400")).when(m == 2, F.lit("abc")).otherwise(F.col("amount_spent"))
    )
    return r.select(
        F.concat(F.lit(f"{_PREFIX}_"), F.col("date"), F.lit("_US_yesterday.zip")).alias("path"),
        F.concat(F.lit(f"{_PREFIX}_"), F.col("date"), F.lit("_US_yesterday_advertisers.csv")).alias("member"),
        (F.col("event_id") + 1).alias("line_no"),
        csv_line(F.col("page_id"), F.col("page_name"), F.lit("d"), amount, F.col("number_of_ads")).alias("line"),
    )


# --- archive listings from event days --------------------------------------------------------


def event_archive_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily archive per event type and day; modified at the day's last event."""
    e = table(spark, sf_dir, "events")
    date = F.date_format("ts", "yyyy-MM-dd")
    path = F.concat(
        F.lit("/reports/"), F.col("event_type"), F.lit(f"/{_PREFIX}_"), date,
        F.lit("_US_yesterday.zip"),
    )
    return e.groupBy(path.alias("path")).agg(F.max("ts").alias("modificationTime"))


def event_member_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate member names of lifelong archives, one per event, grouped by day."""
    e = table(spark, sf_dir, "events")
    date = F.date_format("ts", "yyyy-MM-dd")
    m = F.col("event_id") % 3
    name = (
        F.when(m == 0, F.concat(F.lit(f"{_PREFIX}_"), date, F.lit("_"), F.col("event_type"),
                                F.lit("_US_lifelong_advertisers.csv")))
        .when(m == 1, F.concat(F.lit(f"{_PREFIX}Revamp_"), date, F.lit("_"), F.col("event_type"),
                               F.lit("_US_lifelong_advertisers.csv")))
        .otherwise(F.concat(F.lit("readme_"), F.col("event_type"), F.lit(".txt")))
    )
    return e.select(date.alias("date"), name.alias("member"))
