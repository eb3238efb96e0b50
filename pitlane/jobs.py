"""Command line of the scheduled steps, for ``spark-submit pitlane/jobs.py`` or ``python -m pitlane.jobs``."""

from __future__ import annotations

import argparse
import logging
from datetime import datetime, timezone

from pitlane import schemas as S
from pitlane.operators import silver, staging
from pitlane.plans import pipeline
from pitlane.session import build_session, split_size
from pitlane.sources import bronze


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pitlane")
    steps = parser.add_subparsers(dest="step", required=True)
    today = datetime.now(timezone.utc).strftime("%Y-%m-%d")
    everything = list(S.BRONZE)

    ingest = steps.add_parser("ingest", help="merge landed JSON documents into their tables")
    ingest.add_argument("--landing", required=True)
    ingest.add_argument("--tables", required=True)
    ingest.add_argument("--run-log", required=True)
    ingest.add_argument("--collections", nargs="+", default=["parts_catalog", "market_listings"], choices=everything)
    ingest.add_argument("--makes", nargs="+")
    ingest.add_argument("--quarantine", help="folder for lines, documents and values that the tables cannot hold")
    ingest.add_argument("--model-years", nargs="+", type=int)

    export = steps.add_parser("export", help="export collections as one day of bronze JSON")
    export.add_argument("--source", required=True, help="folder of documents or merged tables, or database")
    export.add_argument("--format", default="json", help="json, parquet, tables (as ingest merged them), or another source")
    export.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    export.add_argument("--bronze", required=True)
    export.add_argument("--collections", nargs="+", default=everything, choices=everything)
    export.add_argument("--run-date", default=today)

    clean = steps.add_parser("silver", help="clean bronze into silver")
    clean.add_argument("--bronze", required=True)
    clean.add_argument("--silver", required=True)
    clean.add_argument("--datasets", nargs="+", default=everything)
    clean.add_argument("--run-date", help="name of the run; all exported days are read")
    clean.add_argument("--update-with", metavar="DAY", help="merge one exported day into silver that is kept up that way")

    gold = steps.add_parser("gold", help="build and validate the marts")
    gold.add_argument("--silver", required=True)
    gold.add_argument("--gold", required=True)
    gold.add_argument("--quotes-from", metavar="BRONZE", help="count a part's sources over all its quotes in bronze")

    local = steps.add_parser("local", help="flat bronze to silver to marts by the single-machine rules")
    for folder in ("--bronze", "--silver", "--gold"):
        local.add_argument(folder, required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    log = logging.getLogger("pitlane")
    args = _parser().parse_args(argv)
    spark = build_session(f"pitlane-{args.step}")
    split_size(spark, widening=True)
    if args.step == "ingest":
        landed = {
            name: bronze.bronze_read_lines(spark, f"{args.landing}/{name}", S.BRONZE[name], told=True)
            for name in args.collections
        }
        pipeline.ingest_run(
            spark, landed, args.tables, args.run_log, datetime.now(timezone.utc), args.makes, args.model_years,
            args.quarantine,
        )
    elif args.step == "export":
        options = dict(pair.split("=", 1) for pair in args.option)
        counts = pipeline.export_run(
            spark, args.source, args.bronze, args.collections, args.run_date, args.format, **options
        )
        log.info("exported %s, %d documents in total", counts, sum(counts.values()))
    elif args.step == "silver" and args.update_with:
        for name in args.datasets:
            landed = bronze.bronze_read_json(spark, args.bronze, name, args.update_with)
            log.info("silver months of %s: %s", name, sorted(pipeline.silver_update(landed, args.silver, name)))
    elif args.step == "silver":
        log.info("silver rows %s", pipeline.silver_run(spark, args.bronze, args.silver, args.datasets, args.run_date))
    elif args.step == "gold":
        quotes = None
        if args.quotes_from:
            raw = bronze.bronze_read_json(spark, args.quotes_from, "parts_catalog")
            quotes = staging.stg_parts(silver.clean_parts(raw))
        pipeline.gold_run(spark, args.silver, args.gold, coverage_input=quotes)
    else:
        pipeline.local_run(spark, args.bronze, args.silver, args.gold)


if __name__ == "__main__":
    main()
