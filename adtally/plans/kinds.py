"""The report-kind dimension: everything that differs between the report loads.

One pipeline serves all kinds; a kind says which archives and members to read, how to
parse them, which date floor applies and which table receives the roll-up.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ReportKind:
    kind: str
    label: str  # time-range label in file names
    folder: str  # download folder of the archives
    days: int  # days covered, the report date being the last one (0: all dates)
    archive_regex: str  # found anywhere in the base name of an archive
    member_regex: str  # found in the member path inside the archive (its folder is fixed)
    floor_date: str  # earliest report date loaded
    target: str  # default target table
    regional: bool  # one member per region, region taken from the member name
    layout: str  # positional layout of the CSV members
    clean_page_id: bool  # keep only digits of page ids
    first_member_only: bool  # read only the alphabetically first matching member
    date_from: str  # "member" or "archive": where the rows' date comes from


# --- fixed values: report naming and loading conventions -------------------------------
REPORT_PREFIX = "FacebookAdLibraryReport"
DEFAULT_FLOOR = "2021-01-06"
NINETY_DAY_FLOOR = "2020-02-09"

KINDS: dict[str, ReportKind] = {
    "daily": ReportKind(
        "daily", "yesterday", "Daily", 1,
        rf"{REPORT_PREFIX}_.*_US_yesterday\.zip",
        rf"^[^/]*{REPORT_PREFIX}[^/]+yesterday_advertisers\.csv",
        DEFAULT_FLOOR, "fb_daily", False, "new", True, False, "member",
    ),
    "daily_region": ReportKind(
        "daily_region", "yesterday", "Daily", 1,
        rf"{REPORT_PREFIX}_.*_US_yesterday\.zip",
        rf"^regions/[^/]*{REPORT_PREFIX}[^/]+yesterday_[^/]+\.csv",
        DEFAULT_FLOOR, "fb_daily_region", True, "regional", True, False, "member",
    ),
    "weekly_region": ReportKind(
        "weekly_region", "last_7_days", "Weekly", 7,
        rf"{REPORT_PREFIX}_.*_US_last_7_days\.zip",
        rf"^regions/[^/]*{REPORT_PREFIX}[^/]+last_7_days_[^/]+\.csv",
        DEFAULT_FLOOR, "fb_weekly_region", True, "regional", True, False, "member",
    ),
    "30days_region": ReportKind(
        "30days_region", "last_30_days", "30Days", 30,
        rf"{REPORT_PREFIX}_.*_US_last_30_days\.zip",
        rf"^regions/[^/]*{REPORT_PREFIX}[^/]+last_30_days_[^/]+\.csv",
        DEFAULT_FLOOR, "fb_30days_region", True, "regional", True, False, "member",
    ),
    "90days_region": ReportKind(
        "90days_region", "last_90_days", "90Days", 90,
        rf"{REPORT_PREFIX}_.*_US_last_90_days\.zip",
        rf"^regions/[^/]*{REPORT_PREFIX}[^/]+last_90_days_[^/]+\.csv",
        NINETY_DAY_FLOOR, "fb_90days_region", True, "regional", True, False, "member",
    ),
    "lifelong": ReportKind(
        "lifelong", "lifelong", "Lifelong", 0,
        rf"{REPORT_PREFIX}_.*_US_lifelong\.zip",
        rf"^[^/]*{REPORT_PREFIX}(Revamp)?_[^/]*_US_lifelong_advertisers\.csv",
        DEFAULT_FLOOR, "fb_lifelong", False, "new", False, True, "archive",
    ),
}
# ---------------------------------------------------------------------------------------


def get_kind(kind: str | ReportKind) -> ReportKind:
    return kind if isinstance(kind, ReportKind) else KINDS[kind]


def kinds_frame(spark: SparkSession) -> DataFrame:
    """The kind dimension as a small constant DataFrame (six rows, fixed)."""
    rows = [asdict(k) for k in KINDS.values()]
    return spark.createDataFrame(rows)
