"""Command-line runner: ``python -m tidemark --root ROOT [--steps ...]``.

Runs the chosen steps (bronze, silver, gold) in order inside one Spark
application and stops at the first failure with a non-zero exit code; the
scheduled 15-minute run is ``--run-at NOW`` with all steps (bronze registers the
run's landing hour, every table continues from its own watermark). Submit with ``spark-submit -m tidemark`` or plain
``python -m tidemark``; cluster settings come from the submit configuration.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    ap.add_argument("--root", required=True, help="lakehouse root (shared storage path)")
    ap.add_argument("--steps", default="bronze,silver,gold", help="comma-separated, run in order")
    ap.add_argument("--source", help="test tables whose feeds the bronze step lands first")
    ap.add_argument("--run-at", type=dt.datetime.fromisoformat,
                    help="run time (UTC, ISO) whose landing hour the bronze step registers")
    for part in ("date", "year", "month", "day", "hour"):
        ap.add_argument(f"--partition-{part}", help=f"landing {part} instead of the run time's")
    ap.add_argument("--layout", default="kv", choices=("kv", "slash"), help="landing directories: "
                    "year_stream=YYYY/... or YYYY/MM/DD/HH")
    ap.add_argument("--full-refresh", action="store_true", help="build the tables of the steps anew")
    ap.add_argument("--recompute-from", help="build the mart's order dates from here on anew")
    ap.add_argument("--grain", default="hour", choices=("hour", "day", "month"),
                    help="partition grain of orders and order lines")
    ap.add_argument("--maintain", action="store_true", help="line dates and mart groups follow late "
                    "and changed orders and lines")
    ap.add_argument("--apply-deletes", action="store_true", help="keys whose newest image is a delete "
                    "are no rows (from the first run on)")
    ap.add_argument("--register", action="store_true", help="declare tables in the catalog")
    ap.add_argument("--log-level", default="ERROR", help="Spark log level (first runs probe "
                    "tables that do not exist yet, which Spark logs as warnings)")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from tidemark.plans.jobs import Lakehouse

    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    spark.sparkContext.setLogLevel(args.log_level)
    house = Lakehouse(spark, args.root, partition_grain=args.grain, layout=args.layout,
                      maintain=args.maintain, apply_deletes=args.apply_deletes)
    overrides = {k: v for k, v in vars(args).items() if k.startswith("partition_") and v}
    steps = [s.strip() for s in args.steps.split(",") if s.strip()]
    try:
        house.run(steps, sf_dir=args.source, full_refresh=args.full_refresh,
                  recompute_from=args.recompute_from, run_at=args.run_at, overrides=overrides)
        if args.register:
            house.register_catalog()
    except Exception as exc:  # stop on the first failing step
        print(f"tidemark: run failed: {exc}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
