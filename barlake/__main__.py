"""Command line for the five jobs.

Run ``python -m barlake <job> ...`` (or the ``barlake`` console script) locally, or
``spark-submit --py-files barlake.zip barlake/__main__.py <job> ...`` on a cluster.

Examples::

    python -m barlake bronze-bars --root s3a://lake --landing s3a://landing/bars --ticker AAA BBB
    python -m barlake silver-bars --root s3a://lake --start-date 2024-01-01 --end-date 2024-01-02
    python -m barlake gold-metrics --root s3a://lake --start-date "2024-01-01 00:00:00" \\
        --end-date "2024-01-01 23:59:59.999999"
"""

from __future__ import annotations

import argparse
import logging
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from barlake.plans import jobs
from barlake.session import pin_session, tune_for_scale
from barlake.streaming import ingest_landing
from barlake.sources.catalog import Lake
from barlake.sources.landing import period_start


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="barlake")
    p.add_argument(
        "job",
        choices=[
            "bronze-bars", "bronze-info", "ingest-bars", "ingest-info",
            "silver-bars", "silver-profile", "gold-metrics",
        ],
    )
    p.add_argument("--root", required=True, help="shared folder holding the layer tables")
    p.add_argument("--catalog", default=None, help="catalog to USE before creating the layers")
    p.add_argument("--landing", help="landing folder (bronze jobs)")
    p.add_argument("--format", default="parquet", help="landing file format: parquet, json or csv")
    p.add_argument("--ticker", nargs="+", help="tickers to load (bronze jobs; default all)")
    p.add_argument("--since", help="earliest bar time to load (bronze bars)")
    p.add_argument("--period", help="bar window ending at the load time: 5d, 1wk, 1mo, 1y, ytd, max")
    p.add_argument("--start-date", help="range start (silver: load time, gold: bar time)")
    p.add_argument("--end-date", help="range end, inclusive")
    p.add_argument("--load-dttm", help="load time to stamp (default: now, UTC)")
    p.add_argument("--input-gb", type=float, help="size of the job's input, to size its shuffles")
    return p


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"barlake-{args.job}").getOrCreate()
    pin_session(spark)
    tune_for_scale(spark, input_bytes=None if args.input_gb is None else int(args.input_gb * 1e9))
    lake = Lake(spark, args.root, catalog=args.catalog).create()
    load_dttm = args.load_dttm or datetime.now(timezone.utc).replace(tzinfo=None)
    if args.job in ("bronze-bars", "bronze-info", "ingest-bars", "ingest-info") and not args.landing:
        raise SystemExit("--landing is required for bronze jobs")
    if args.job in ("ingest-bars", "ingest-info"):
        # Incremental: only files of the landing folder not loaded before, one load per micro-batch.
        kind = "bars" if args.job == "ingest-bars" else "info"
        ingest_landing(lake, args.landing, kind, fmt=args.format).awaitTermination()
        return
    if args.job == "bronze-bars":
        since = args.since
        if args.period and since is None:
            as_of = load_dttm if isinstance(load_dttm, datetime) else datetime.fromisoformat(load_dttm)
            since = period_start(args.period, as_of)
        jobs.bronze_bars_job(lake, args.landing, load_dttm, args.ticker, since, args.format)
    elif args.job == "bronze-info":
        jobs.bronze_info_job(lake, args.landing, load_dttm, args.ticker, args.format)
    elif args.job == "silver-bars":
        jobs.silver_bars_job(lake, args.start_date, args.end_date, load_dttm)
    elif args.job == "silver-profile":
        jobs.silver_profile_job(lake, args.start_date, args.end_date, load_dttm)
    else:
        jobs.gold_metrics_job(lake, args.start_date, args.end_date, load_dttm)


if __name__ == "__main__":
    main()
