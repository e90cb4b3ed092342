"""Command line: ``python -m shopstrata --root DIR COMMAND ...`` (submit it with spark-submit)."""

from __future__ import annotations

import argparse
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import SparkSession

from .operators import windows
from .operators.charts import CHARTS
from .plans import backfill, build, ingest, monitor, reporting, state
from .sources import config_files, landing
from .sources.config_files import registry_frame
from .sources.tables import GRAINS, Warehouse
from .streaming.order_stream import start_order_stream


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="shopstrata", description=__doc__)
    parser.add_argument("--root", required=True, help="warehouse directory on a shared file system")
    parser.add_argument("--grain", choices=sorted(GRAINS), default="month", help="period of a partition")
    parser.add_argument("--now", type=datetime.fromisoformat, help="clock of the run, default: the current time")
    parser.add_argument("--out", help="folder for the rows of metrics, chart and counts; default: print them all")
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *options: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        for option in options:
            sub.add_argument(option, required=True)
        return sub

    for name, text in (("ingest", "load the feed"), ("backfill", "load and build a past interval again")):
        sub = add(name, text, "--feed")
        sub.add_argument("--platform", help="platform of messages without a platform directory")
        sub.add_argument("--dead-letter-limit", type=float, default=ingest.IngestSettings.dead_letter_limit)
        sub.add_argument("--start", type=datetime.fromisoformat, required=name == "backfill")
        sub.add_argument("--end", type=datetime.fromisoformat)
        if name == "ingest":
            sub.add_argument("--shops", help="registry of shops whose watermark advances even if they sent nothing")
            sub.add_argument("--overlap", type=float, default=60, help="minutes before the watermark that are read again")
            sub.add_argument("--delay", type=float, default=5, help="minutes before now that are left to the next run")
            sub.add_argument("--no-checks", action="store_true", help="do not run the data-quality rules")
            sub.add_argument("--run-type", choices=(windows.INCREMENTAL, windows.FULL), default=windows.INCREMENTAL)
        else:
            sub.add_argument("--shops", required=True)
    sub = add("stream", "load the feed as a stream", "--feed", "--checkpoint")
    sub.add_argument("--platform")
    sub.add_argument("--levels", default="", help="comma-separated directory levels: platform, arrived, shop_id")
    sub.add_argument("--every", help="processing interval; without it, what is there is loaded once")
    sub = add("build", "build facts, dimensions, summaries and reports", "--shops")
    how = sub.add_mutually_exclusive_group()
    how.add_argument("--days", type=int, default=windows.REBUILD_DAYS)
    how.add_argument("--full", action="store_true")
    how.add_argument("--since", type=date.fromisoformat)
    sub = add("scan", "check the raw tables of the last hours", "--shops")
    sub.add_argument("--hours", type=int, default=24)
    add("sync-rules", "register configured data-quality rules", "--rules")
    add("metrics", "pipeline health")
    add("chart", "one dashboard query").add_argument("name", choices=sorted(CHARTS))
    sub = add("expire", "delete data that only older versions of the tables name")
    sub.add_argument("--keep", type=int, default=2, help="versions of each table to keep")
    sub = add("counts", "row counts of stored tables")
    sub.add_argument("tables", nargs="+")
    return parser


def _run(args: argparse.Namespace, spark: SparkSession) -> object:
    wh = Warehouse(spark, args.root, grain=args.grain)
    now = args.now or windows.to_business_time(datetime.now().astimezone()).replace(microsecond=0)
    if args.command in ("ingest", "backfill"):
        settings = ingest.IngestSettings(dead_letter_limit=args.dead_letter_limit)
        if args.command == "ingest":
            settings = replace(
                settings, overlap=timedelta(minutes=args.overlap), delay=timedelta(minutes=args.delay),
                run_checks=not args.no_checks,
            )
        messages = landing.scan_feed(spark, args.feed, platform=args.platform, updated_since=args.start)
        if args.command == "backfill":
            shops = config_files.parse_registry(config_files.load_document(args.shops))
            return state.run_task(wh, "backfill", "backfill", lambda: backfill.backfill(
                wh, messages, shops, start=args.start, end=args.end, now=now, settings=settings
            ))
        kind, window = windows.resolve_run(windows.BACKFILL if args.start else args.run_type, args.start, args.end)
        silent = None
        if args.shops:
            silent = registry_frame(spark, config_files.parse_registry(config_files.load_document(args.shops)))
        if kind == windows.INCREMENTAL and window is None:
            return state.run_task(wh, "ingest", "ingest", lambda: ingest.ingest_directory(
                wh, args.feed, now=now, platform=args.platform, settings=settings, shops=silent
            ))
        return state.run_task(wh, "ingest", "ingest", lambda: ingest.ingest_batch(
            wh, messages, now=now, run_type=kind, window=window, settings=settings, shops=silent
        ))
    if args.command == "stream":
        levels = tuple(x for x in args.levels.split(",") if x)
        return start_order_stream(
            wh, args.feed, args.checkpoint, platform=args.platform, levels=levels, every=args.every
        ).awaitTermination()
    if args.command == "build":
        since = args.since or (windows.FULL_REBUILD_START if args.full else now.date() - timedelta(days=args.days - 1))
        shops = config_files.parse_registry(config_files.load_document(args.shops))
        return state.run_task(wh, "build", "build", lambda: build.build_warehouse(wh, shops, since=since, now=now))
    if args.command == "scan":
        shops = config_files.parse_registry(config_files.load_document(args.shops))
        return state.run_task(
            wh, "scan", "scan", lambda: monitor.scan_quality(wh, shops, now=now, hours=args.hours)
        )
    if args.command == "sync-rules":
        return state.sync_rules(wh, config_files.parse_rules(config_files.load_document(args.rules)), now)
    if args.command == "expire":
        state.tidy_logs(wh, 0)
        for name in sorted(wh.names()):
            wh.compact(name)
        return {name: gone for name in sorted(wh.names()) if (gone := wh.expire(name, args.keep))}
    shown = {
        "metrics": lambda: reporting.pipeline_metrics(wh, now),
        "chart": lambda: reporting.chart(wh, args.name),
        "counts": lambda: monitor.row_counts(wh, args.tables),
    }[args.command]()
    if args.out:
        shown.write.mode("overwrite").json(args.out)
    else:
        for row in shown.toLocalIterator():
            print(row.asDict())
    return None


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    result = _run(args, SparkSession.builder.appName(f"shopstrata {args.command}").getOrCreate())
    if result is not None:
        print(result)


if __name__ == "__main__":
    main()
