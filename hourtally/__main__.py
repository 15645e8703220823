"""Command line: ``python -m hourtally``, or this file with ``spark-submit --py-files``.

    load-pagecounts   --source DIR --target DIR [--run-time ISO [--until ISO]]
    load-mediacounts  --source DIR --target DIR [--run-time ISO [--until ISO]]
                      [--missing] [--database NAME] [--input-bytes N --cores N]
    ingest-pagecounts  --source DIR --root DIR [--every "1 minute"] [--listed]
    ingest-mediacounts --source DIR --root DIR [--every "1 minute"] [--listed]
    report NAME --table DIR [--project P] [--article A] [--since now-3d] [--until now-1d]
                [--now-delay 1d] [--lo EPOCH --hi EPOCH]
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from hourtally.functions.timegrain import day_string, relative_epoch, run_times
from hourtally.operators.filters import DEFAULT_NOW_DELAY
from hourtally.operators.ingest import MEDIACOUNTS, PAGECOUNTS
from hourtally.plans import jobs, reports
from hourtally.session import build_session, sizing_conf
from hourtally.sources import paths
from hourtally.sources.tables import read_mediacounts, read_pagecounts
from hourtally.streaming.file_ingest import FileIngest

REPORTS = (
    "hourly_total_views",
    "hourly_views_by_project",
    "hourly_views_by_article",
    "hourly_rows_and_views",
    "relative_rows_and_views",
    "daily_media_totals",
)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="hourtally")
    commands = top.add_subparsers(dest="command", required=True)
    for kind, lag in (("pagecounts", 1), ("mediacounts", 2)):
        load = commands.add_parser(f"load-{kind}")
        load.add_argument("--source", required=True)
        load.add_argument("--target", required=True)
        load.add_argument("--run-time", help="ISO-8601; default: now")
        load.add_argument("--until", help="last run time of a backfill")
        load.add_argument(
            "--missing", action="store_true", help="only what no load has read yet, if it is there now"
        )
        load.add_argument("--database", help="external tables to tell of the load")
        load.add_argument("--lag-days", type=int, default=lag)
        load.add_argument("--archive-names", action="store_true", help="published file names")
        load.add_argument("--row-ids", action="store_true")
        load.add_argument("--input-bytes", type=int, help="uncompressed; sizes the shuffle")
        load.add_argument("--cores", type=int, default=1, help="of the cluster, with --input-bytes")
        ingest = commands.add_parser(f"ingest-{kind}")
        ingest.add_argument("--source", required=True)
        ingest.add_argument("--root", required=True)
        ingest.add_argument("--every", help="look again this often; default: once")
        ingest.add_argument("--max-files", type=int, default=10_000)
        ingest.add_argument(
            "--listed", action="store_true", help="files without load records: list all of --source"
        )
        ingest.add_argument("--generation", type=int, default=0)
        ingest.add_argument(
            "--most-directories", type=int, help="compact days that a batch leaves with more"
        )
        ingest.add_argument("--take-over", action="store_true", help="from a driver that is lost")
    report = commands.add_parser("report")
    report.add_argument("name", choices=REPORTS)
    report.add_argument("--table", required=True)
    report.add_argument("--first-date", default="2022-01-01")
    report.add_argument("--last-date")
    report.add_argument("--project")
    report.add_argument("--article")
    report.add_argument("--since", default="now-3d")
    report.add_argument("--until", default="now-1d")
    report.add_argument("--as-of")
    report.add_argument("--now-delay", default=DEFAULT_NOW_DELAY)
    report.add_argument("--lo", type=int, help="first hour of a fixed range")
    report.add_argument("--hi", type=int, help="last hour of a fixed range")
    report.add_argument("--out", help="write parquet here instead of printing")
    return top


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.input_bytes:
        for key, value in sizing_conf(args.input_bytes, args.cores).items():
            spark.conf.set(key, value)
    pages = args.command == "load-pagecounts"
    if pages:
        layout = paths.HOURLY_ARCHIVE if args.archive_names else paths.HOURLY_STAGED
        job, store, catch_up = jobs.load_pagecounts, jobs.store_pagecounts, jobs.load_missing_pagecounts
    else:
        layout = paths.DAILY_ARCHIVE if args.archive_names else paths.DAILY_STAGED
        job, store, catch_up = jobs.load_mediacounts, jobs.store_mediacounts, jobs.load_missing_mediacounts
    if args.missing:
        last = args.until or args.run_time
        found = catch_up(
            spark, args.run_time, last, args.source, args.target, args.lag_days, layout,
            args.row_ids, args.database,
        )
        print(f"{len(found)} loaded")
        return
    runs = [args.run_time]
    if args.until:
        runs = run_times(args.run_time, args.until, 1 if pages else 24)
    store(job(spark, runs, args.source, args.lag_days, layout), args.target, args.row_ids, args.database)


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    table = PAGECOUNTS if args.command == "ingest-pagecounts" else MEDIACOUNTS
    files = FileIngest(
        table, args.source, args.root, args.generation, args.max_files, listed=args.listed,
        most_directories=args.most_directories, take_over=args.take_over,
    )
    print(files.target)
    files.run(spark, args.every)


def report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    media = args.name == "daily_media_totals"
    read = read_mediacounts if media else read_pagecounts
    first, last = args.first_date, args.last_date
    as_of = args.as_of or datetime.now(timezone.utc)
    hours = None
    if args.name == "hourly_rows_and_views":
        hours = args.lo, args.hi
    elif args.name == "relative_rows_and_views":
        hours = tuple(relative_epoch(e, as_of, args.now_delay) for e in (args.since, args.until))
    if hours:
        # Only the days of these hours are listed.
        first, end = max(first, day_string(hours[0])), day_string(hours[1])
        last = min(last or end, end)
    table = read(spark, args.table, first, last)
    values = {}
    if args.name == "hourly_views_by_article":
        values = {"article": args.article}
    elif args.name == "hourly_views_by_project" and args.project:
        values = {"project": args.project}
    elif args.name == "hourly_rows_and_views":
        values = {"lo": args.lo, "hi": args.hi, "project": args.project}
    elif args.name == "relative_rows_and_views":
        values = {
            "since": args.since,
            "until": args.until,
            "as_of": as_of,
            "now_delay": args.now_delay,
            "project": args.project,
        }
    return getattr(reports, args.name)(table, **values)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if getattr(args, "name", None) == "hourly_views_by_article" and not args.article:
        parser().error("hourly_views_by_article needs --article")
    if getattr(args, "name", None) == "hourly_rows_and_views" and None in (args.lo, args.hi):
        parser().error("hourly_rows_and_views needs --lo and --hi")
    spark = build_session(f"hourtally {args.command}")
    if args.command.startswith("load"):
        load(spark, args)
    elif args.command.startswith("ingest"):
        ingest(spark, args)
    else:
        result = report(spark, args)
        if args.out:
            result.write.parquet(args.out)
        else:
            print(*result.columns, sep="\t")
            for row in result.toLocalIterator():
                print(*row, sep="\t")


if __name__ == "__main__":
    main()
