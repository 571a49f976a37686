"""Command line: ``python -m shelfwise <command>``.

    load   RAW STAGING WAREHOUSE   clean, check, promote through the gate; exit code 1 if the gate stays shut
    check  FOLDER                  run the standard checks on a stored star; exit code 1 on failure
    report RAW                     cleaning log, checks and verdict for a raw extract, without storing anything
    kpi    FOLDER                  the headline figures
    run    FOLDER NAME             any question, view, report, metric or measure; --by and --where for measures

Folders hold Parquet tables, or CSV extracts with ``--csv``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from shelfwise.operators.clean import clean_all
from shelfwise.operators.quality import dq_report, gate, gate_verdict, run_checks
from shelfwise.plans.executive import mv_executive_kpis
from shelfwise.plans.insights import INSIGHTS
from shelfwise.plans.load import gated_load
from shelfwise.plans.measures import FUNCTIONS
from shelfwise.plans.questions import QUESTIONS
from shelfwise.plans.reports import REPORTS
from shelfwise.plans.views import VIEWS
from shelfwise.session import build_session
from shelfwise.sources.star import Star, from_csv, from_parquet

NAMED = {**QUESTIONS, **VIEWS, **REPORTS, **INSIGHTS, "mv_executive_kpis": mv_executive_kpis}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="shelfwise", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    top.add_argument("--csv", action="store_true", help="the input folder holds CSV extracts")
    commands = top.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load")
    for name in ("folder", "staging", "warehouse"):
        load.add_argument(name)
    for name in ("check", "report", "kpi"):
        commands.add_parser(name).add_argument("folder")
    run = commands.add_parser("run")
    run.add_argument("folder")
    run.add_argument("name", choices=[*NAMED, *FUNCTIONS], metavar="NAME")
    run.add_argument("--by", nargs="*", default=None, help="grain of a measure")
    run.add_argument("--where", nargs="*", default=[], metavar="ATTR=VALUE", help="filter of a measure")
    run.add_argument("--rows", type=int, default=20, help="rows to print")
    return top


def _filters(pairs: list[str]) -> dict[str, object]:
    split = (p.split("=", 1) for p in pairs)
    return {k: int(v) if v.lstrip("-").isdigit() else v for k, v in split}


def _result(star: Star, args):
    if args.name in NAMED:
        return NAMED[args.name](star)
    options = {"filters": _filters(args.where)}
    if args.by is not None:
        options["group_cols"] = tuple(args.by)
    return FUNCTIONS[args.name](star, **options)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or build_session()
    star = (from_csv if args.csv else from_parquet)(spark, args.folder)
    if args.command == "load":
        passed = gated_load(star, args.staging, args.warehouse)
        print("gate passed" if passed else "gate failed")
        return 0 if passed else 1
    if args.command == "check":
        results = run_checks(star)
        dq_report(results).orderBy("check_name").show(100, truncate=False)
        return 0 if gate(results) else 1
    if args.command == "report":
        cleaned, log = clean_all(star)
        results = run_checks(cleaned)
        for rows in (log.orderBy("table_name"), dq_report(results).orderBy("check_name"), gate_verdict(results)):
            rows.show(100, truncate=False)
        return 0
    if args.command == "kpi":
        REPORTS["kpi_report"](star).show(truncate=False)
        return 0
    _result(star, args).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
