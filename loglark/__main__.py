"""Jobs for spark-submit.

    split   <file> <parent folder> <lines per batch> [--many-files]
    check   <batch folder> <output folder>
    run     <batch folder> <root> <run id> [--engine NAME] [--queries all|1|2|3] [--load N]
            [--separately 1,2,...]
    report  <root> <run id> <output folder> [--engines a,b,...]
    history <root> <output folder>
    compact <root> <run id> [--vacuum]
    differ  <root> <run id> <output folder> [--engines a,b,...]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from loglark.operators.runs import ENGINES
from loglark.plans.reports import all_reports, result_differences, run_history_json
from loglark.plans.run import read_run_tables, read_runs, run_batches, split_dataset
from loglark.session import configure
from loglark.sources.loads import vacuum
from loglark.sources.tables import compact_loads, write_run_history
from loglark.sources.text import count_check, export_query, read_batches


def numbers(text: str) -> list[int]:
    return [int(x) for x in text.split(",") if x]


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="loglark")
    jobs = parser.add_subparsers(dest="job", required=True)

    split = jobs.add_parser("split", help="cut a log file into batch files")
    split.add_argument("path")
    split.add_argument("parent")
    split.add_argument("lines", type=int)
    split.add_argument("--many-files", action="store_true", help="batches too large for one task")

    check = jobs.add_parser("check", help="batches whose lines are not as many as their name declares")
    check.add_argument("folder")
    check.add_argument("out")

    run = jobs.add_parser("run", help="parse and query a folder of batch files")
    run.add_argument("folder")
    run.add_argument("root")
    run.add_argument("run_id", type=int)
    run.add_argument("--engine", default="spark", help="label stored with the run")
    run.add_argument("--queries", default="all")
    run.add_argument("--load", type=int, default=0)
    run.add_argument("--separately", type=numbers, default=[], help="batches to load and time one by one")

    report = jobs.add_parser("report", help="write all reports about a run")
    report.add_argument("root")
    report.add_argument("run_id", type=int)
    report.add_argument("out")
    report.add_argument("--engines", help="engines listed with or without a run")

    history = jobs.add_parser("history", help="write the finished runs as JSON lines")
    history.add_argument("root")
    history.add_argument("out")

    compact = jobs.add_parser("compact", help="rewrite all loads of a run as one")
    compact.add_argument("root")
    compact.add_argument("run_id", type=int)
    compact.add_argument("--vacuum", action="store_true", help="delete what no reader needs any more")

    differ = jobs.add_parser("differ", help="write every number in which the scorecard's runs differ")
    differ.add_argument("root")
    differ.add_argument("run_id", type=int)
    differ.add_argument("out")
    differ.add_argument("--engines")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = configure(SparkSession.builder.appName(f"loglark {args.job}")).getOrCreate()
    if args.job == "split":
        split_dataset(spark, args.path, args.parent, args.lines, one_file=not args.many_files)
    elif args.job == "check":
        export_query(count_check(read_batches(spark, args.folder)), args.out)
    elif args.job == "run":
        dataset = args.folder.rstrip("/").rsplit("/", 1)[-1]
        lines = read_batches(spark, args.folder)
        run_batches(
            lines, args.root, dataset, args.engine, args.run_id, args.load, args.queries, args.separately
        )
    elif args.job == "report":
        engines = args.engines.split(",") if args.engines else ENGINES
        tables = read_run_tables(spark, args.root)
        found = all_reports(**tables, run_id=args.run_id, engines=engines)
        for name, table in found.items():
            export_query(table, f"{args.out}/{name}")
    elif args.job == "compact":
        compact_loads(spark, args.root, args.run_id)
        if args.vacuum:
            vacuum(spark, args.root)
    elif args.job == "differ":
        engines = args.engines.split(",") if args.engines else ENGINES
        found = read_run_tables(spark, args.root)
        names = ("runs", "daily", "top", "top_hosts", "hours", "hour_hosts")
        export_query(result_differences(*[found[n] for n in names], args.run_id, engines), args.out)
    else:
        write_run_history(run_history_json(read_runs(spark, args.root)), args.out)


if __name__ == "__main__":
    main()
