"""Job entry point, usable with ``spark-submit`` or ``python -m retail_signals``.

    run-pipeline RAW_DIR OUT_DIR [--lenient] [--check-keys]
    diagnose ARTIFACTS_DIR [--anomaly-id ID] [--all] [--out DIR]

The session comes from the submit configuration (``getOrCreate``); the job
never stops a session it did not create.
"""
from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.jobs import run_diagnosis, run_pipeline


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="retail_signals")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run-pipeline", help="three CSV inputs -> five Parquet tables")
    run.add_argument("raw_dir")
    run.add_argument("out_dir")
    run.add_argument("--lenient", action="store_true", help="malformed values become null")
    run.add_argument("--check-keys", action="store_true", help="fail on duplicate keys")
    diag = sub.add_parser("diagnose", help="diagnosis report from stored tables")
    diag.add_argument("artifacts_dir")
    diag.add_argument("--anomaly-id", default=None)
    diag.add_argument("--all", action="store_true", help="diagnose every anomaly (Parquet)")
    diag.add_argument("--out", default=None)
    args = parser.parse_args(argv)

    own = spark is None and SparkSession.getActiveSession() is None
    spark = spark or SparkSession.builder.appName("retail_signals").getOrCreate()
    try:
        if args.command == "run-pipeline":
            paths = run_pipeline(spark, args.raw_dir, args.out_dir, lenient=args.lenient,
                                 check_keys=args.check_keys)
            for name, path in paths.items():
                print(f"{name}\t{path}")
        else:
            result = run_diagnosis(spark, args.artifacts_dir, args.out, args.anomaly_id,
                                   all_anomalies=args.all)
            if args.all:
                print(f"diagnosed {result.count()} anomalies")
            else:
                print(result.select("explanation").first()["explanation"])
    finally:
        if own:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
