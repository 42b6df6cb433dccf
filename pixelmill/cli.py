"""Command line: ``python -m pixelmill.cli run --stage filter|label|all --config FILE [--run-id ID]``."""

from __future__ import annotations

import argparse


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pixelmill")
    run = parser.add_subparsers(dest="command", required=True).add_parser("run")
    run.add_argument("--stage", choices=("filter", "label", "all"), required=True)
    run.add_argument("--config", required=True)
    run.add_argument("--run-id")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parse_args(argv)
    from pyspark.sql import SparkSession

    from pixelmill.config import load_config
    from pixelmill.plans.runner import PipelineRunner

    spark = spark or SparkSession.builder.appName("pixelmill").getOrCreate()
    runner = PipelineRunner(spark, load_config(args.config), run_id=args.run_id)
    print({"filter": runner.run_filter, "label": runner.run_label, "all": runner.run_all}[args.stage]())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
