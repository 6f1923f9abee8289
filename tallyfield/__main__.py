"""Jobs for spark-submit:  python -m tallyfield --store <folder> <command> ...

    extract SEASON...           load every table for the seasons        (--landing)
    refresh-season SEASON       reload one season                       (--landing, --tables)
    refresh-week SEASON WEEK    reload one week of the weekly stats     (--landing)
    refresh-raw-ecr             rebuild raw rankings from rank files    (--ranks)
    refresh-transformed-ecr     link rankings to player ids
    refresh-summary             rebuild the season summary              (--run-tests, --changed)
    query                       run SQL                                 (--sql or --file, --output)
    validate                    quality report of all tables
    schema                      columns of all tables
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tallyfield.operators import quality
from tallyfield.plans import ranks, refresh, reports
from tallyfield.schemas import LOAD_TABLES
from tallyfield.session import tune
from tallyfield.sources import quarantine, rankfiles
from tallyfield.sources.landing import Landing
from tallyfield.sources.warehouse import Warehouse, export

#: Rows of a result that are printed unless --limit says otherwise.
SHOWN = 1000


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyfield", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--store", required=True, help="folder of the stored tables")
    p.add_argument("--landing", help="folder of the landing data, one sub-folder per table")
    p.add_argument("--format", default="parquet", choices=("parquet", "orc", "csv", "json"), help="landing format")
    p.add_argument("--limit", type=int, default=SHOWN, help="rows printed of a result; 0 prints all")
    p.add_argument("--output", help="write results here instead: a target ending in .csv or .parquet, else JSON lines")
    p.add_argument("--keep-rejects", action="store_true", help="loads keep rows with cells that do not convert")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("extract").add_argument("seasons", nargs="+", type=int)
    one = sub.add_parser("refresh-season")
    one.add_argument("season", type=int)
    one.add_argument("--tables", nargs="*")
    week = sub.add_parser("refresh-week")
    week.add_argument("season", type=int)
    week.add_argument("week", type=int)
    sub.add_parser("refresh-raw-ecr").add_argument("--ranks", required=True, help="folder of the rank files")
    sub.add_parser("refresh-transformed-ecr")
    summary = sub.add_parser("refresh-summary")
    summary.add_argument("--run-tests", action="store_true")
    summary.add_argument("--changed", action="store_true", help="only seasons whose inputs have changed")
    summary.add_argument("--expect", help="CSV file: season, position, rank_column, expected_rank, name_part")
    q = sub.add_parser("query")
    text = q.add_mutually_exclusive_group(required=True)
    text.add_argument("--sql")
    text.add_argument("--file")
    q.add_argument("--output", dest="query_output", help="as the option of the same name before the command")
    sub.add_parser("validate")
    sub.add_parser("schema")
    sub.add_parser("rejects", help="cells that did not convert, counted by load, column and reason").add_argument("tables", nargs="*")
    return p


class _Out:
    """Prints results, or writes each to a folder of its own."""

    def __init__(self, limit: int, output: str | None):
        self.limit, self.output, self.written = limit, output, 0

    def __call__(self, df: DataFrame) -> None:
        if self.output:
            stem, dot, ending = self.output.rpartition(".")
            again = f"{stem}-{self.written + 1}{dot}{ending}" if dot else f"{self.output}-{self.written + 1}"
            export(df, again if self.written else self.output)
            self.written += 1
            return
        rows = df.limit(self.limit + 1).collect() if self.limit else df.collect()
        shown = rows[: self.limit] if self.limit else rows
        print("\t".join(df.columns))
        for row in shown:
            print("\t".join("NULL" if v is None else str(v) for v in row))
        if len(rows) > len(shown):
            print(f"... more rows than {self.limit}; use --limit or --output")


def run(spark: SparkSession, argv: list[str]) -> int:
    """Run one command in ``spark``; returns the exit code."""
    args = _parser().parse_args(argv)
    store = Warehouse(spark, args.store)
    _show = _Out(args.limit, getattr(args, "query_output", None) or args.output)
    if args.command in ("extract", "refresh-season", "refresh-week"):
        if not args.landing:
            raise SystemExit("--landing is needed")
        landing = Landing(spark, args.landing, args.format)
        if args.command == "extract":
            counts = refresh.extract_all(store, landing, args.seasons, keep_rejects=args.keep_rejects)
        elif args.command == "refresh-season":
            counts = refresh.refresh_season(store, landing, args.season, args.tables, keep_rejects=args.keep_rejects)
        else:
            counts = {"weekly_stats": refresh.refresh_week(store, landing, args.season, args.week)}
        for table, n in counts.items():
            print(f"{table}: {n:,} rows")
        if args.command == "extract":
            loaded = store.frames([t for t, n in counts.items() if n])
            _show(reports.validation_report(loaded, null_threshold=reports.AFTER_LOAD))
    elif args.command == "refresh-raw-ecr":
        print(f"raw_ecr_rankings: {refresh.refresh_raw_rankings(store, args.ranks):,} rows")
        files, rows = rankfiles.list_files(spark, args.ranks), rankfiles.read_rankings(spark, args.ranks)
        _show(rankfiles.file_report(files, rows))
        raw = store.read("raw_ecr_rankings")
        _show(ranks.coverage_by_year(raw))
        _show(ranks.verify(raw))
    elif args.command == "refresh-transformed-ecr":
        refresh.refresh_linked_rankings(store)
        raw, linked = store.read("raw_ecr_rankings"), store.read("ecr_rankings")
        _show(ranks.match_report(raw, linked))
        _show(ranks.match_types(linked, store.read("rosters")))
        _show(ranks.unmatched_names(raw, linked))
    elif args.command == "refresh-summary":
        counts = refresh.refresh_summaries(store, only_changed=args.changed)
        for table, n in counts.items():
            print(f"{table}: {n:,} rows")
        if not all(counts.values()):
            return 1
        if args.run_tests:
            summary = store.read("smry_season")
            checks = reports.summary_checks(store.read("seasonal_stats"), summary)
            _show(checks)
            failed = checks.where("NOT passed").count()
            for expected, tops in reports.golden_ranks(spark, summary, args.expect) if args.expect else ():
                _show(expected)
                for top in tops:
                    failed += 1
                    _show(top)
            return int(failed > 0)
    elif args.command == "query":
        store.register_views()
        for result in [store.query(args.sql)] if args.sql else store.query_file(args.file):
            _show(result)
    elif args.command == "validate":
        _show(reports.kept_report(store))
    elif args.command == "rejects":
        _show(quarantine.report(store, args.tables or LOAD_TABLES))
    elif args.command == "schema":
        _show(quality.describe(spark, store.frames()))
    return 0


if __name__ == "__main__":
    sys.exit(run(tune(SparkSession.builder.appName("tallyfield").getOrCreate()), sys.argv[1:]))
