"""Command line: ``python -m punctuality {run,explore,land} ...``."""

import argparse
import time

from pyspark.sql import SparkSession

from punctuality.operators import delays
from punctuality.plans.pipeline import Settings, run
from punctuality.schema import MIN_FLIGHTS, SAMPLE_FRACTION, TOP_K, TREE_DEPTH
from punctuality.session import get_session
from punctuality.sources.flights import land, read_first_available, read_flights, read_landed


def explore(spark: SparkSession, path: str, min_flights: int = MIN_FLIGHTS) -> None:
    """Print the three analyses of raw records whose schema is inferred."""
    flights = read_flights(spark, path, infer=True)
    delays.delay_causes(flights).show(truncate=False)
    origins = delays.origin_delays(flights)
    delays.top_origin_delays(origins, min_flights=min_flights).show(TOP_K, truncate=False)
    # Twelve months, and one row for dates that cannot be read.
    delays.monthly_delays(flights).show(13, truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="punctuality")
    commands = parser.add_subparsers(dest="command", required=True)

    full = commands.add_parser("run", help="run the whole pipeline")
    full.add_argument("paths", nargs="+", help="CSV paths, tried in order")
    full.add_argument("--landed", action="store_true", help="the paths are landed Parquet tables, all read")
    full.add_argument("--output", help="folder for the JSON result document")
    full.add_argument("--min-flights", type=int, default=MIN_FLIGHTS)
    full.add_argument("--sample-fraction", type=float, default=SAMPLE_FRACTION)
    full.add_argument("--max-depth", type=int, default=TREE_DEPTH)
    full.add_argument("--random-draws", action="store_true", help="draw row by row, not by key")
    full.add_argument("--categorical", action="store_true", help="treat carriers as categories")
    full.add_argument(
        "--index-on-whole-sample", action="store_true", help="number carriers on test rows too"
    )

    raw = commands.add_parser("explore", help="show the analyses of raw records")
    raw.add_argument("path")
    raw.add_argument("--min-flights", type=int, default=MIN_FLIGHTS)

    landing = commands.add_parser("land", help="write CSV as Parquet by year")
    landing.add_argument("paths", nargs="+", help="CSV paths, tried in order")
    landing.add_argument("--target", required=True)
    landing.add_argument("--mode", default="errorifexists", help="Spark's save mode")
    landing.add_argument(
        "--no-rebalance", action="store_true", help="input comes in order of date, no shuffle"
    )

    args = parser.parse_args(argv)
    began = time.perf_counter()
    spark = get_session()
    if args.command == "run":
        settings = Settings(
            min_flights=args.min_flights,
            sample_fraction=args.sample_fraction,
            max_depth=args.max_depth,
            random_draws=args.random_draws,
            categorical=args.categorical,
            index_on_whole_sample=args.index_on_whole_sample,
        )
        flights = read_landed(spark, *args.paths) if args.landed else None
        run(spark, args.paths, args.output, settings, engine_start=began, flights=flights)
    elif args.command == "explore":
        explore(spark, args.path, args.min_flights)
        print(f"{time.perf_counter() - began:.2f} seconds")
    else:
        flights, _ = read_first_available(spark, args.paths)
        land(flights, args.target, mode=args.mode, rebalance=not args.no_rebalance)


if __name__ == "__main__":
    main()
