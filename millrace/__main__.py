"""Command line: ``python -m millrace CONFIG.json COMMAND``, for spark-submit or a timer.

The exit status is not zero when a stage fails, a mirror differs from its source, or a topic is
older than the freshness limit.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from pathlib import Path

from millrace.config import PipelineConfig
from millrace.operators import latest_hours
from millrace.plans import (
    STAGES,
    Flow,
    Folders,
    backfill,
    restore,
    run_incremental,
    run_pipeline,
    take_back,
)
from millrace.plans.batch import counts, stale_topics
from millrace.schemas import GOLD_STATS
from millrace.session import get_spark


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace")
    parser.add_argument("config", type=Path)
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="all stages, or only the named ones")
    run.add_argument("stages", nargs="*", choices=[*STAGES, []])
    run.add_argument("--source", action="append", default=[], metavar="ENTITY=PARQUET")
    incremental = commands.add_parser("incremental", help="what came in since the last run")
    incremental.add_argument("root", help="shared folder of the files and checkpoints")
    days = commands.add_parser("backfill", help="rebuild from the first date up to the second")
    days.add_argument("start", type=dt.date.fromisoformat)
    days.add_argument("end", type=dt.date.fromisoformat)
    undo = commands.add_parser("take-back", help="undo a backfill of the same dates")
    undo.add_argument("start", type=dt.date.fromisoformat)
    undo.add_argument("end", type=dt.date.fromisoformat)
    fresh = commands.add_parser("freshness", help="topics that are too old")
    fresh.add_argument("now", type=dt.datetime.fromisoformat)
    for command in (days, undo, fresh):
        command.add_argument("--root", help="shared folder of a deployment that runs by loads")
    summed = commands.add_parser("sum-up", help="add up the partial statistics of all loads")
    summed.add_argument("root")
    back = commands.add_parser("restore", help="make an older version of a table current")
    back.add_argument("table")
    back.add_argument("version", type=int)
    commands.add_parser("counts", help="rows of each mirror")
    commands.add_parser("report", help="the newest hours, busiest zones first")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    cfg = PipelineConfig.from_json(args.config.read_text())
    spark = get_spark(f"millrace {args.command}")
    if args.command == "run":
        named = (pair.split("=", 1) for pair in args.source)
        sources = {name: spark.read.parquet(path) for name, path in named}
        report = run_pipeline(spark, cfg, sources, args.stages or tuple(STAGES))
        for name, rows in report.rows.items():
            print(f"{name}: {rows} rows")
    elif args.command == "incremental":
        run_incremental(spark, cfg, Folders(args.root))
    elif args.command == "sum-up":
        print(f"up to load {Flow(spark, cfg, Folders(args.root)).sum_up()}")
    elif args.command in ("backfill", "take-back"):
        flow = Flow(spark, cfg, Folders(args.root)) if args.root else None
        if args.command == "backfill":
            done = flow.backfill(args.start, args.end) if flow else backfill(spark, cfg, args.start, args.end).rows
        else:
            done = flow.take_back(args.start, args.end) if flow else take_back(spark, cfg, args.start, args.end).rows
        for name, rows in done.items():
            print(f"{name}: {rows} rows")
    elif args.command == "restore":
        restore(spark, cfg, args.table, args.version)
    elif args.command == "counts":
        counts(spark, cfg).show(truncate=False)
    elif args.command == "report":
        latest_hours(spark.table(cfg.table(GOLD_STATS))).show(truncate=False)
    else:
        flow = Flow(spark, cfg, Folders(args.root)) if args.root else None
        stale = flow.stale_topics(args.now) if flow else stale_topics(spark, cfg, args.now)
        stale.show(truncate=False)
        return 0 if stale.isEmpty() else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
