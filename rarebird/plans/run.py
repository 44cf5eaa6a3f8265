"""Command line: run the composed training or prediction job from a settings file.

    python -m rarebird.plans.run train settings.json [--table-root PATH] [--on-error record|raise]

The settings file holds the nested layout the original jobs read (optionally under a top-level
``parametros_modelo`` key). The session is the one the cluster provides (``spark-submit``).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from rarebird.plans import jobs


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="rarebird.plans.run")
    parser.add_argument("stage", choices=["train", "predict"])
    parser.add_argument("settings")
    parser.add_argument("--table-root", default=None)
    parser.add_argument("--on-error", choices=["record", "raise"], default="record")
    args = parser.parse_args(argv)
    with open(args.settings, encoding="utf-8") as fh:
        settings = json.load(fh)
    settings = settings.get("parametros_modelo", settings)
    spark = SparkSession.builder.appName(f"rarebird-{args.stage}").getOrCreate()
    cfg = jobs.JobConfig.from_mapping(settings, args.stage, table_root=args.table_root)
    run = jobs.training_job if args.stage == "train" else jobs.prediction_job
    report = run(spark, cfg, on_error=args.on_error)
    failed = [r.error for r in (report.anomalies, report.segments) if r.error is not None]
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
