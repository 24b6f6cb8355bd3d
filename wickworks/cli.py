"""Command line: python -m wickworks.cli COMMAND.

features --config FILE                                             features of a candle dataset
extract --config FILE [--download-only | --process-only]          archives, fetched and made candles of
download --base-url URL --symbol NAME --start DAY --end DAY        archives only, without a file of settings
daily --input FOLDER --output FOLDER                               daily CSV files of archives
yearly --input FOLDER --output FOLDER --format csv|parquet|xlsx    yearly files of daily ones
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from wickworks.plans import runs
from wickworks.sinks import legacy
from wickworks.sources import config as cf


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="run", required=True)
    one = commands.add_parser("download")
    for name in ("--base-url", "--symbol", "--start", "--end"):
        one.add_argument(name, required=True)
    one.add_argument("--market", default="um")
    one.add_argument("--interval", default="1h")
    one.add_argument("--datasets", nargs="+", default=["klines"], choices=("klines", "aggTrades"))
    one.add_argument("--output", default="data/raw")
    one.add_argument("--retries", type=int, default=3)
    one.add_argument("--workers", type=int, default=4)
    one.add_argument("--extract", action="store_true", help="write each archive's CSV beside it")
    for name in ("features", "extract", "daily", "yearly"):
        one = commands.add_parser(name)
        one.add_argument("--overwrite", action="store_true", help="replace files that are there")
        if name in ("features", "extract"):
            one.add_argument("--config", type=Path, required=True)
        else:
            one.add_argument("--input", required=True)
            one.add_argument("--output", required=True)
        if name == "extract":
            mode = one.add_mutually_exclusive_group()
            mode.add_argument("--download-only", action="store_true")
            mode.add_argument("--process-only", action="store_true", help="from archives that are there, without network requests")
        if name == "yearly":
            one.add_argument("--format", choices=("csv", "parquet", "xlsx"), default="parquet")
    return parser.parse_args(argv)


def _yearly(spark: SparkSession, args: argparse.Namespace) -> str:
    mode = "overwrite" if args.overwrite else "ignore"
    if args.format == "xlsx":
        return f"{legacy.merge_xlsx(spark, args.input, args.output)} rows"
    merge = legacy.merge_csv if args.format == "csv" else legacy.merge_years
    return f"{len(merge(spark, args.input, args.output, mode))} yearly files"


def main(argv: list[str] | None = None) -> int:
    """0: done, 1: failed, 2: bad settings, 130: interrupted."""
    args = _arguments(argv)
    try:
        if args.run in ("features", "extract"):
            settings, base = cf.load_yaml(args.config), args.config.resolve().parent
            config = cf.feature_config(settings, base) if args.run == "features" else cf.extract_config(settings, base)
        elif args.run == "download":
            settings = {"market": args.market, "symbol": args.symbol, "interval": args.interval, "start_date": args.start, "end_date": args.end, "output_format": "csv", "datasets": args.datasets,
                        "raw_folder": args.output, "base_url": args.base_url, "download_retries": args.retries, "download_workers": args.workers}
            config = cf.extract_config(settings)
    except (OSError, ValueError) as e:
        print(f"Configuration error: {e}", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("wickworks").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if args.run == "features":
            print(f"done: {runs.generate_dataset(spark, config)['rows']} rows")
        elif args.run == "extract":
            for r in runs.run_extractor(spark, config, args.download_only, args.process_only, args.overwrite):
                print(f"{r['symbol']}: {r['status']}, " + (f"{r['rows']} rows" if "rows" in r else f"{r['archives']} archives"))
        elif args.run == "download":
            for r in runs.download(spark, config, args.extract):
                print(f"{r['symbol']}: {r['status']}, {r['archives']} archives")
        elif args.run == "daily":
            print(f"{len(legacy.daily_csv(spark, args.input, args.output, 'overwrite' if args.overwrite else 'ignore'))} daily files")
        else:
            print(_yearly(spark, args))
        return 0
    except KeyboardInterrupt:
        return 130
    except Exception as e:
        print(f"Run failed: {type(e).__name__}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
