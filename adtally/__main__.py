"""Command line: ``python -m adtally`` or ``spark-submit adtally/__main__.py``.

    load   --kind K --source DIR [--target T] [--second-target T2] [--reader R]
           [--on-date-mismatch M] [--on-malformed M] [--problems DIR]
    shared --source DIR --targets daily=fb_daily,daily_region=fb_daily_region
    ingest --kind K --source DIR --checkpoint DIR [--interval "2 hours"], and as for load
    totals --table T [--threshold 0.5]

Each run is one scheduled job: it loads what is new and exits (``ingest`` without
``--interval`` drains with availableNow). Spark settings come from spark-submit. Targets lie
in ``spark.sql.warehouse.dir``; a later run finds them there even if the session's catalog
keeps nothing. Archives that can't be loaded are listed, and the exit status is then 1.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from adtally.plans.kinds import KINDS
from adtally.plans.loader import DATE_MISMATCH, ON_MALFORMED, run_batch, run_shared_archives
from adtally.sources.archive import READERS
from adtally.sources.tables import PathSink, open_table


def _load_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--second-target")
    p.add_argument("--reader", default="archive", choices=READERS)
    p.add_argument("--on-date-mismatch", default="fail", choices=DATE_MISMATCH)
    p.add_argument("--on-malformed", default="keep", choices=ON_MALFORMED)
    p.add_argument("--problems", help="folder for records per archive, member and parse status")


def _chosen(args: argparse.Namespace) -> dict:
    return {
        "target": args.target, "second_target": args.second_target, "reader": args.reader,
        "on_date_mismatch": args.on_date_mismatch, "on_malformed": args.on_malformed,
        "problems": PathSink(args.problems) if args.problems else None,
    }


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="adtally", description="Load ad-spend report archives.")
    sub = p.add_subparsers(dest="command", required=True)

    load = sub.add_parser("load", help="batch-load the new reports of one kind")
    load.add_argument("--kind", required=True, choices=sorted(KINDS))
    load.add_argument("--source", required=True)
    load.add_argument("--target")
    _load_options(load)

    shared = sub.add_parser("shared", help="load kinds that share archives, reading them once")
    shared.add_argument("--source", required=True)
    shared.add_argument("--targets", required=True, help="kind=table,kind=table")

    ingest = sub.add_parser("ingest", help="Structured Streaming ingest of one kind")
    ingest.add_argument("--kind", required=True, choices=sorted(KINDS))
    ingest.add_argument("--source", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--target")
    _load_options(ingest)
    ingest.add_argument("--interval", help="poll interval; without it, drain and stop")
    ingest.add_argument("--max-files-per-trigger", type=int)

    totals = sub.add_parser("totals", help="totals per date with day-over-day flags")
    totals.add_argument("--table", required=True)
    totals.add_argument("--threshold", type=float, default=0.5)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"adtally-{args.command}").getOrCreate()
    if args.command == "load":
        loaded = run_batch(spark, args.kind, args.source, on_reject="return", **_chosen(args))
        result = {"kind": args.kind, "loaded_dates": loaded, "rejected": loaded.rejected}
    elif args.command == "shared":
        targets = dict(pair.split("=", 1) for pair in args.targets.split(","))
        loaded = run_shared_archives(spark, args.source, targets, on_reject="return")
        rejected = sorted({r for dates in loaded.values() for r in dates.rejected})
        result = {"loaded_dates": loaded, "rejected": rejected}
    elif args.command == "ingest":
        from adtally.streaming.ingest import start_ingest

        query = start_ingest(
            spark, args.kind, args.source, args.checkpoint,
            available_now=args.interval is None, interval=args.interval or "2 hours",
            max_files_per_trigger=args.max_files_per_trigger, **_chosen(args),
        )
        query.awaitTermination()
        result = {"kind": args.kind, "batches": len(query.recentProgress)}
    else:
        from adtally.operators.diagnostics import day_over_day, totals_by_date

        flagged = day_over_day(totals_by_date(open_table(spark, args.table)), args.threshold)
        # one row per report date: a bounded result, printed for the operator
        rows = flagged.filter("flag <> 'ok'").orderBy("date").collect()
        result = {"flagged": [(r.date, r.flag) for r in rows]}
    print(json.dumps(result))
    return result


def cli() -> int:
    """Console-script entry: exit status 0 once the job has finished, 1 if it left out archives."""
    return 1 if main().get("rejected") else 0


if __name__ == "__main__":
    sys.exit(cli())
