"""Command line: every job over tables on any path Spark can read."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.times import EARLY_WRAPS
from skyledger.plans import reports
from skyledger.plans.delays import delay_stats
from skyledger.plans.fleet import (
    TIES,
    flights_per_tail,
    flights_with_airline,
    rollup_delta,
    top_models_from_rollup,
    top_models_per_airline,
)
from skyledger.plans.top_models import top_models
from skyledger.session import build_session
from skyledger.sources import incremental, layouts, quarantine, schemas
from skyledger.sources.mixed_headers import read_flights_by_header
from skyledger.sources.tables import (
    FORMATS,
    read_aircrafts,
    read_airlines,
    read_flights,
)


LOADED = {
    "flights": schemas.FLIGHTS_FILE,
    "aircrafts": schemas.AIRCRAFTS,
    "airlines": schemas.AIRLINES,
}


def _flights(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.headers_differ:
        return read_flights_by_header(spark, args.flights)
    return read_flights(spark, args.flights, fmt=args.format)


def _airlines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return read_airlines(spark, args.airlines, fmt=args.format)


def _aircrafts(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    # A cut or overlong line would give an aircraft another one's fields.
    options = {"drop_malformed": True} if args.format == "csv" else {}
    return read_aircrafts(spark, args.aircrafts, fmt=args.format, **options)


def _fleet_lines(ranked: DataFrame, ties: str) -> DataFrame:
    exact = ties == "exact"
    return reports.fleet_lines(ranked) if exact else reports.ranked_lines(ranked)


def _write_report(lines: DataFrame, path: str) -> None:
    lines.write.text(path)


def run_top_models(spark: SparkSession, args: argparse.Namespace) -> None:
    top = top_models(
        _flights(spark, args), _aircrafts(spark, args), flown_only=args.flown_only
    )
    _write_report(reports.model_lines(top), args.out)


def run_delays(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.layout:
        flights = layouts.read_flights_by_year(
            spark, args.flights, fmt=args.layout_format
        ).filter(F.col("year") == args.year)
    else:
        flights = _flights(spark, args)
    stats = delay_stats(
        flights,
        _airlines(spark, args),
        None if args.layout else args.year,
        country=args.country,
        early_wrap=args.early_wrap,
    )
    _write_report(reports.delay_lines(stats), args.out)


def run_fleet(spark: SparkSession, args: argparse.Namespace) -> None:
    ranked = top_models_per_airline(
        _flights(spark, args),
        _airlines(spark, args),
        _aircrafts(spark, args),
        args.country,
        ties=args.ties,
    )
    _write_report(_fleet_lines(ranked, args.ties), args.out)


def run_fleet_from_rollup(spark: SparkSession, args: argparse.Namespace) -> None:
    rollup = layouts.read_country_rollup(spark, args.rollup, fmt=args.layout_format)
    ranked = top_models_from_rollup(
        rollup, _aircrafts(spark, args), args.country, ties=args.ties
    )
    _write_report(_fleet_lines(ranked, args.ties), args.out)


def run_layout_flights(spark: SparkSession, args: argparse.Namespace) -> None:
    layouts.write_flights_by_year(
        _flights(spark, args),
        args.out,
        keys=args.keys,
        fmt=args.out_format,
        max_records_per_file=args.max_records,
    )


def run_layout_rollup(spark: SparkSession, args: argparse.Namespace) -> None:
    layouts.write_country_rollup(
        flights_per_tail(_flights(spark, args), _airlines(spark, args)),
        args.out,
        fmt=args.out_format,
        max_records_per_file=args.max_records,
    )


def run_layout_country(spark: SparkSession, args: argparse.Namespace) -> None:
    layouts.write_country_flights(
        flights_with_airline(_flights(spark, args), _airlines(spark, args)),
        args.out,
        fmt=args.out_format,
        max_records_per_file=args.max_records,
        by_tail=args.by_tail,
    )


def run_layout_tail(spark: SparkSession, args: argparse.Namespace) -> None:
    layouts.write_country_tail(
        flights_with_airline(_flights(spark, args), _airlines(spark, args)),
        args.out,
        fmt=args.out_format,
        max_records_per_file=args.max_records,
        parts=args.parts,
    )


def run_load(spark: SparkSession, args: argparse.Namespace) -> None:
    quarantine.load_csv(
        spark, args.source, args.out, LOADED[args.table], header=not args.no_header
    )


def run_load_days(spark: SparkSession, args: argparse.Namespace) -> None:
    incremental.load_days(_flights(spark, args), args.out, keys=args.keys)


def run_apply_delta(spark: SparkSession, args: argparse.Namespace) -> None:
    delta = rollup_delta(
        _airlines(spark, args),
        flown=read_flights(spark, args.flown, fmt=args.format) if args.flown else None,
        cancelled=(
            read_flights(spark, args.cancelled, fmt=args.format) if args.cancelled else None
        ),
    )
    incremental.apply_delta(delta, args.out, args.name)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="skyledger", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, run, *tables: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for table in tables:
            sub.add_argument(f"--{table}", required=True)
        if "flights" in tables:
            sub.add_argument(
                "--headers-differ",
                action="store_true",
                help="flights are CSV files, each with a header of its own",
            )
        sub.add_argument("--format", choices=FORMATS, default="csv")
        sub.add_argument("--out", required=True)
        sub.add_argument("--shuffle-partitions", type=int)
        sub.set_defaults(run=run)
        return sub

    top = command("top-models", run_top_models, "flights", "aircrafts")
    top.add_argument("--flown-only", action="store_true")

    delays = command("delays", run_delays, "flights", "airlines")
    delays.add_argument("--year", type=int, required=True)
    delays.add_argument("--country")
    delays.add_argument("--early-wrap", choices=EARLY_WRAPS, default="signed")
    delays.add_argument(
        "--layout", action="store_true", help="flights are in directories by year"
    )

    fleet = command("fleet", run_fleet, "flights", "airlines", "aircrafts")
    stored = command("fleet-from-rollup", run_fleet_from_rollup, "rollup", "aircrafts")
    for sub in (fleet, stored):
        sub.add_argument("--country", required=True)
        sub.add_argument("--ties", choices=TIES, default="keep")

    for sub in (delays, stored):
        sub.add_argument("--layout-format", choices=FORMATS, default="parquet")

    by_year = command("layout-flights", run_layout_flights, "flights")
    by_year.add_argument(
        "--keys", nargs="+", choices=layouts.YEAR_CARRIER, default=layouts.YEAR_CARRIER
    )
    rollup = command("layout-rollup", run_layout_rollup, "flights", "airlines")
    by_country = command("layout-country", run_layout_country, "flights", "airlines")
    by_country.add_argument("--by-tail", action="store_true")
    by_tail = command("layout-tail", run_layout_tail, "flights", "airlines")
    by_tail.add_argument("--parts", type=int, help="ranges of country and tail")
    for sub in (by_year, rollup, by_country, by_tail):
        sub.add_argument("--out-format", choices=FORMATS, default="parquet")
        sub.add_argument("--max-records", type=int, default=layouts.ROWS_PER_FILE)

    load = command("load", run_load, "source")
    load.add_argument("--table", choices=sorted(LOADED), required=True)
    load.add_argument("--no-header", action="store_true")
    days = command("load-days", run_load_days, "flights")
    days.add_argument(
        "--keys", nargs="+", choices=layouts.YEAR_CARRIER, default=layouts.YEAR_CARRIER
    )
    delta = command("apply-delta", run_apply_delta, "airlines")
    delta.add_argument("--flown", help="flights to count")
    delta.add_argument("--cancelled", help="flights counted before that were cancelled")
    delta.add_argument("--name", required=True, help="a delta of a name is applied once")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = build_session(
        f"skyledger-{args.command}", partitions=args.shuffle_partitions
    )
    args.run(spark, args)
