"""Batch report loads: archives of one kind → repaired, parsed, rolled-up table rows.

``build_report`` is the pure transformation (lines → roll-up); ``load_listing`` adds the
choice of new reports, the rejection of bad archives and the idempotent write;
``run_batch`` lists a folder and runs both. The streaming ingest calls ``load_listing`` for
every micro-batch of new files.

A load reads each archive once. Its parsed lines are summed per archive, member and parse
status into a small staging table; the target's rows, the parse problems and the archives
to reject all come from there.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.functions.clean import base_name, region_from_name, report_date
from adtally.operators.diagnostics import totals_by_date
from adtally.operators.lines import drop_header, parse_lines, split_bom, spread_lines
from adtally.operators.records import join_records
from adtally.operators.rollup import censored_sums, clean_records, national_rollup, regional_rollup, spend_bounds
from adtally.plans.kinds import ReportKind, get_kind
from adtally.session import shared_dir
from adtally.sources.archive import (
    archive_files,
    choose_new,
    list_archives,
    read_archive_lines,
    select_archives,
)
from adtally.sources.published import PublishedSink, check_shared, publish
from adtally.sources.tables import (
    Sink,
    create_target,
    empty_dates,
    loaded_in_all,
    overwrite_dates,
    overwrite_dates_two_sinks,
    record_loads,
    replace_dates,
    with_ledger,
)

DATE_MISMATCH = ("fail", "use_archive_date")
ON_MALFORMED = ("keep", "drop", "realign")
LINES_DDL = "path string, member string, line_no long, line string"
ON_REJECT = ("raise", "return")
UNREADABLE = "unreadable"
MALFORMED = ("short", "long")


def _file_dates() -> tuple:
    return report_date(base_name("path")), report_date(base_name("member"))


def attach_file_fields(
    lines: DataFrame, kind: str | ReportKind, on_date_mismatch: str = "fail"
) -> DataFrame:
    """Add ``date`` (and ``region`` for regional kinds) from archive and member names.

    Rows take the member's date; when it differs from the archive's date the job fails
    (``on_date_mismatch="fail"``) or takes the archive's (``"use_archive_date"``), so the
    loaded-date check and the written partition always agree. Lifelong reports take the
    archive's date. (A load finds such members first, see ``mismatch_reason``, and rejects
    their archives alone.)
    """
    if on_date_mismatch not in DATE_MISMATCH:
        raise ValueError(f"on_date_mismatch must be one of {DATE_MISMATCH}")
    k = get_kind(kind)
    # file-level values: computed once per row as columns that later columns of the same
    # select refer to (lateral aliases), then dropped
    archive_date, member_date = F.col("_archive_date"), F.col("_member_date")
    if k.date_from == "archive" or on_date_mismatch == "use_archive_date":
        date = archive_date
    else:
        date = F.when(member_date.eqNullSafe(archive_date), member_date).otherwise(
            F.raise_error(_mismatch_text())
        )
    from_archive, from_member = _file_dates()
    cols = [from_archive.alias("_archive_date"), from_member.alias("_member_date"), date.alias("date")]
    if k.regional:
        cols.append(region_from_name("member", k.label).alias("region"))
    return lines.select(*[F.col(c) for c in lines.columns], *cols).drop(
        "_archive_date", "_member_date"
    )


def _mismatch_text():
    return F.concat(
        F.lit("report date of member "), F.col("member"),
        F.lit(" differs from its archive "), F.col("path"),
    )


def mismatch_reason(kind: ReportKind, on_date_mismatch: str):
    """Why a member's archive is to be rejected, or null: its date isn't the archive's."""
    if kind.date_from == "archive" or on_date_mismatch == "use_archive_date":
        return F.lit(None).cast("string")
    from_archive, from_member = _file_dates()
    return F.when(~from_member.eqNullSafe(from_archive), _mismatch_text())


def parse_records(
    lines: DataFrame,
    kind: str | ReportKind,
    on_date_mismatch: str = "fail",
    repair_bom: bool = True,
    repair_quotes: bool = True,
    spread: bool = True,
    partitions: int | None = None,
    layout: str | None = None,
    realign: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Member lines (``path, member, line_no, line``) → cleaned records of ``kind``.

    With ``spread``, lines from fewer input partitions than ``partitions`` (default: the
    cores now there) are first hash-spread over them (see ``spread_lines``); give
    ``partitions`` where executors come and go. ``layout`` replaces the kind's. ``realign``:
    see ``parse_lines``. ``multiline``: quoted fields may hold line breaks (see ``join_records``);
    meant for files whose quotes are sound, so with ``repair_quotes`` off.
    """
    k = get_kind(kind)
    if spread:
        lines = spread_lines(lines, partitions)
    if multiline:
        lines = join_records(lines)
    df = attach_file_fields(lines, k, on_date_mismatch)
    if repair_bom:
        df = split_bom(df)
    else:
        df = df.filter(F.col("line") != "").withColumn("piece", F.lit(0))
    parsed = parse_lines(drop_header(df), layout or k.layout, repair_quotes=repair_quotes, realign=realign)
    return clean_records(parsed, clean_page_id=k.clean_page_id)


def build_report(lines: DataFrame, kind: str | ReportKind, on_date_mismatch: str = "fail", **options) -> DataFrame:
    """Member lines → target rows of ``kind``; ``options`` as for ``parse_records``."""
    return roll_up(parse_records(lines, kind, on_date_mismatch, **options), kind)


def roll_up(records: DataFrame, kind: str | ReportKind) -> DataFrame:
    return regional_rollup(records) if get_kind(kind).regional else national_rollup(records)


# --- staging ------------------------------------------------------------------------------


def stage(lines: DataFrame, kind: str | ReportKind, on_date_mismatch: str = "fail", **options) -> DataFrame:
    """The records' sums per archive, member, status and target key, written once.

    Lines numbered -1 (an archive that can't be read) and members of another date become
    rows of status ``unreadable`` with a ``reason``. Everything a load writes comes from
    here, and the archives' bytes are read for this table alone.
    """
    k = get_kind(kind)
    reason = F.when(F.col("line_no") < 0, F.col("line")).otherwise(mismatch_reason(k, on_date_mismatch))
    marked = lines.withColumn("reason", reason)
    # an unreadable line must get past the header rule, the repairs and the date rule
    marked = marked.withColumn("line", F.when(F.col("reason").isNull(), F.col("line")).otherwise("-"))
    records = parse_records(marked, k, "use_archive_date", **options)
    status = F.when(F.col("reason").isNotNull(), UNREADABLE).otherwise(F.col("status"))
    keys = ["page_name", "disclaimer", "page_id", "date", *(["region"] if k.regional else [])]
    sums = (
        records.withColumn("status", status)
        .groupBy("path", "member", "status", "amount_invalid", "reason", *keys)
        .agg(
            F.sum("amount").alias("amount"), F.sum("ads").alias("ads"), F.count(F.lit(1)).alias("n_records"), *censored_sums()
        )
    )
    spark = lines.sparkSession
    place = shared_dir(spark, "adtally", "staged") + f"/{uuid.uuid4().hex}"
    sums.write.parquet(place)
    return spark.read.schema(sums.schema).parquet(place)


def staged_problems(staged: DataFrame) -> DataFrame:
    """Records per archive, member and status, and why an archive was rejected."""
    return staged.groupBy("path", "member", "status", "amount_invalid", "reason", "date").agg(
        F.sum("n_records").alias("n_records")
    )


PROBLEM_COLUMNS = ["path", "member", "status", "amount_invalid", "reason", "n_records", "date"]


class Loaded(list):
    """The report dates loaded; ``rejected`` holds (archive, reason) of what was not."""

    def __init__(self, dates=(), rejected=()):
        super().__init__(dates)
        self.rejected: list[tuple[str, str]] = sorted(rejected)


class RejectedArchives(RuntimeError):
    """Raised after the sound archives are stored; ``loaded`` as if nothing was rejected."""

    def __init__(self, loaded, rejected: list[tuple[str, str]]):
        super().__init__("archives not loaded: " + "; ".join(f"{p}: {r}" for p, r in rejected))
        self.loaded = loaded
        self.rejected = rejected


# --- loads --------------------------------------------------------------------------------


@dataclass(frozen=True)
class _New:
    """The archives that a load is to read: (path, modification time, report date) each."""

    archives: list[tuple]
    undated: list[str]
    replaced: set[str]  # dates that are already in the target, from an older archive

    @property
    def paths(self) -> list[str]:
        return [a[0] for a in self.archives]


def load_listing(
    spark: SparkSession,
    listing: DataFrame,
    kind: str | ReportKind,
    target: Sink | None = None,
    second_target: Sink | None = None,
    floor_date: str | None = "kind",
    on_date_mismatch: str = "fail",
    loaded: DataFrame | None = None,
    reader: str = "archive",
    problems: Sink | None = None,
    on_malformed: str = "keep",
    on_reject: str = "raise",
    bounds: Sink | None = None,
    totals: Sink | None = None,
    **options,
) -> Loaded:
    """Load the new reports of an archive listing; return the report dates loaded.

    ``listing`` has ``path, modificationTime, report_date`` (see ``select_archives``).
    Only archives past the floor whose date is missing from a target, or was loaded from an
    older archive, are read at all. ``loaded`` replaces the targets' own dates as the set of
    loaded dates (for example ``loaded_dates_jdbc`` when the rows also go to a relational
    store). ``reader``: see ``read_archive_lines``; no size decides it.

    An archive that is damaged, has no matching member, no date in its name or members of
    another date is rejected; all others are stored. ``on_reject``: ``raise``
    RejectedArchives afterwards, or ``return`` them in the result's ``rejected``.
    ``on_malformed``: ``drop`` leaves out records with too few or too many fields,
    ``realign`` puts over-wide ones right where their ends fit (see ``parse_lines``).
    ``problems``: a sink for records per archive, member and status. ``bounds``: a sink for
    the spend's bounds by target key (censored amounts count from 0 to what is written).
    ``totals``: a sink for each date's totals; only the loaded dates change in it. All come
    from the load's one pass. Further ``options`` as for ``parse_records``.
    """
    for value, known in ((on_date_mismatch, DATE_MISMATCH), (on_malformed, ON_MALFORMED), (on_reject, ON_REJECT)):
        if value not in known:
            raise ValueError(f"{value!r} is none of {known}")
    k = get_kind(kind)
    sinks = [target or k.target] + ([second_target] if second_target else [])
    check_shared(sinks)
    floor = k.floor_date if floor_date == "kind" else floor_date
    new = _new_archives(spark, listing, k, sinks, floor, loaded)
    result = Loaded(rejected=_undated(new))
    if new.archives:
        lines = read_archive_lines(spark, new.paths, k, reader=reader)
        more = {"bounds": bounds, "totals": totals}
        result = _load_lines(lines, new, k, sinks, problems, on_malformed, on_date_mismatch, more, **options)
    if result.rejected and on_reject == "raise":
        raise RejectedArchives(result, result.rejected)
    return result


def _undated(new: _New) -> list[tuple[str, str]]:
    return [(p, "no report date in the archive's name") for p in new.undated]


def _new_archives(spark, listing, k, sinks, floor, loaded=None) -> _New:
    for t in sinks:
        if isinstance(t, str):
            create_target(spark, t, regional=k.regional)
    done = loaded if loaded is not None else with_ledger(spark, sinks[0], loaded_in_all(spark, sinks))
    chosen = choose_new(listing, done, floor).select("path", "modificationTime", "report_date")
    known = done.select(F.col("date").cast("string").alias("report_date"), F.lit(True).alias("known")).distinct()
    undated = listing.filter(F.col("report_date").isNull()).select("path")
    # names and dates of the new reports, and names without a date: a few rows of metadata
    rows = chosen.join(F.broadcast(known), "report_date", "left").unionByName(undated, allowMissingColumns=True).collect()
    dated = sorted((r for r in rows if r.report_date is not None), key=lambda r: r.report_date)
    return _New(
        [(r.path, r.modificationTime, r.report_date) for r in dated],
        [r.path for r in rows if r.report_date is None],
        {r.report_date for r in dated if r.known},
    )


def _load_lines(
    lines: DataFrame, new: _New, k: ReportKind, sinks: list[Sink], problems: Sink | None,
    on_malformed: str, on_date_mismatch: str, more: dict[str, Sink | None] | None = None, **options,
) -> Loaded:
    spark = lines.sparkSession
    if on_malformed == "realign":
        options["realign"] = True
    staged = stage(lines, k, on_date_mismatch, **options)
    bad = staged.filter(F.col("status") == UNREADABLE)
    # one row per rejected archive
    rejected = [(r.path, r.reason) for r in bad.groupBy("path").agg(F.min("reason").alias("reason")).collect()]
    out = {p for p, _ in rejected}
    sound = [a for a in new.archives if a[0] not in out]
    if problems is not None:
        overwrite_dates(staged_problems(staged).select(*PROBLEM_COLUMNS), problems)
    if sound:
        good = staged
        if out:
            good = staged.join(F.broadcast(bad.select("path").distinct()), "path", "left_anti")
        if on_malformed == "drop":
            good = good.filter(~F.col("status").isin(*MALFORMED))
        report, dates = roll_up(good, k), [d for _, _, d in sound]
        side = {"bounds": spend_bounds(good, k.regional), "totals": totals_by_date(report)}
        # before the rows: a date counts as loaded once its rows are there
        for name, sink in (more or {}).items():
            if sink is not None:
                replace_dates(side[name], sink, dates)
        _store(report, good, sound, new.replaced, sinks)
    return Loaded([d for _, _, d in sound], [*rejected, *_undated(new)])


def _store(report: DataFrame, staged: DataFrame, sound: list[tuple], replaced: set[str], sinks: list[Sink]) -> None:
    """Put the rows of the sound archives' dates into the sinks; an empty report empties its date."""
    spark, dates = report.sparkSession, [d for _, _, d in sound]
    if isinstance(sinks[0], PublishedSink):
        publish(report, sinks, dates, sound)
        return
    filled = {r.date for r in staged.select("date").distinct().collect()}
    record_loads(spark, sinks[0], [a for a in sound if a[2] not in replaced])
    if len(sinks) > 1:
        overwrite_dates_two_sinks(report, sinks[0], sinks[1], sorted(filled))
    else:
        overwrite_dates(report, sinks[0])
    for sink in sinks:
        empty_dates(spark, sink, sorted(set(dates) - filled))
    record_loads(spark, sinks[0], [a for a in sound if a[2] in replaced])


def run_shared_archives(
    spark: SparkSession,
    source_dir: str,
    targets: dict[str, str],
    on_date_mismatch: str = "fail",
    reader: str = "archive",
    on_malformed: str = "keep",
    on_reject: str = "raise",
    **options,
) -> dict[str, Loaded]:
    """Load several kinds that come in the same archives (the daily archive holds the
    national and the regional report) while unpacking each archive once.

    ``targets`` maps kind → table. Each kind keeps its own floor and loaded dates; the
    lines of the union of new archives are unpacked once into a table in the shared folder,
    partitioned by kind, and each kind is loaded from its part. An archive that lacks one
    kind's members is rejected for that kind alone. Returns the report dates per kind.
    """
    kinds = [get_kind(k) for k in targets]
    if len({k.archive_regex for k in kinds}) != 1 or any(k.first_member_only for k in kinds):
        raise ValueError("kinds must share the archive pattern and read all members")
    listing = select_archives(archive_files(spark, source_dir), kinds[0])
    plan = {k.kind: _new_archives(spark, listing, k, [targets[k.kind]], k.floor_date) for k in kinds}
    every = sorted({p for new in plan.values() for p in new.paths})
    out: dict[str, Loaded] = {}
    rejected = sorted({r for new in plan.values() for r in _undated(new)})
    if every:
        members = "|".join(f"(?:{k.member_regex})" for k in kinds)
        lines = read_archive_lines(spark, every, kinds[0], reader=reader, member_regex=members)
        of_kind = reduce(lambda c, k: c.when(F.col("member").rlike(k.member_regex), k.kind), kinds, F.when(F.lit(False), ""))
        place = shared_dir(spark, "adtally", "lines") + f"/{uuid.uuid4().hex}"
        lines.withColumn("kind", F.coalesce(of_kind, F.lit("none"))).write.partitionBy("kind").parquet(place)
        kept = spark.read.schema(f"{LINES_DDL}, kind string").parquet(place)
        for k in kinds:
            new = plan[k.kind]
            if not new.archives:
                continue
            wanted = spark.createDataFrame([(p,) for p in new.paths], "path string")
            # lines of the kind, and of archives that can't be read at all
            mine = kept.filter(F.col("kind").isin(k.kind, "none")).drop("kind").join(F.broadcast(wanted), "path", "left_semi")
            missing = wanted.join(mine.select("path").distinct(), "path", "left_anti").select(
                "path", F.lit(None).cast("string").alias("member"), F.lit(-1).cast("long").alias("line_no"),
                F.lit(f"no {k.kind} report CSV in archive").alias("line"),
            )
            loaded = _load_lines(
                mine.unionByName(missing), new, k, [targets[k.kind]], None, on_malformed, on_date_mismatch, **options
            )
            rejected = sorted({*rejected, *loaded.rejected})
            out[k.kind] = loaded
    if rejected and on_reject == "raise":
        raise RejectedArchives(out, rejected)
    return out


def run_batch(
    spark: SparkSession,
    kind: str | ReportKind,
    source_dir: str,
    **options,
) -> Loaded:
    """List ``source_dir`` and load every new report of ``kind`` (see ``load_listing``)."""
    return load_listing(spark, list_archives(spark, source_dir, kind), kind, **options)
