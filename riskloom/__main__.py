"""Command line: ``python -m riskloom {ingest,features,train,evaluate,score} ...``."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException

from riskloom.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="riskloom")
    steps = parser.add_subparsers(dest="step", required=True)
    p = steps.add_parser("ingest", help="CSV files to staging table")
    p.add_argument("--csv", nargs="+", required=True)
    p.add_argument("--staging", required=True)
    p.add_argument("--max-unreadable", type=int, default=0)
    p = steps.add_parser("features", help="staging table to curated features")
    p.add_argument("--staging", required=True)
    p.add_argument("--curated", required=True)
    p = steps.add_parser("train", help="curated features to model bundle")
    p.add_argument("--curated", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--version", default="1")
    p.add_argument("--trials", type=int, default=50)
    p = steps.add_parser("evaluate", help="report tables for a model bundle")
    p.add_argument("--staging", required=True)
    p.add_argument("--curated", required=True)
    p.add_argument("--bundle", required=True)
    p.add_argument("--out", required=True)
    p = steps.add_parser("score", help="score a curated table")
    p.add_argument("--curated", required=True)
    p.add_argument("--bundle", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--split", choices=["train", "val", "test"])
    p.add_argument("--limit", type=int)
    p.add_argument("--expected-pr-auc", type=float)
    return parser


def run(args: argparse.Namespace) -> None:
    from riskloom.models.score import load_bundle
    from riskloom.plans import evaluate, features, ingest, scoring, training
    from riskloom.sources.sinks import write_curated

    spark = build_session()
    if args.step == "ingest":
        done = ingest.ingest(spark, args.csv, args.staging, args.max_unreadable)
        done.quality.show(truncate=False)
        done.nulls.show(truncate=False)
    elif args.step == "features":
        staging = features.staging_to_transactions(spark.read.parquet(args.staging))
        write_curated(features.build_features(staging), args.curated)
    elif args.step == "train":
        training.train_model(spark.read.parquet(args.curated), args.out, args.version, args.trials)
    elif args.step == "evaluate":
        staging = features.staging_to_transactions(spark.read.parquet(args.staging))
        found = evaluate.evaluate(spark.read.parquet(args.curated), staging, load_bundle(args.bundle))
        found.write_reports(args.out)
        found.log(f"{args.out}/runs")
        found.test_metrics.show(truncate=False)
        found.calibration.show(truncate=False)
        found.cost_optimum.show(truncate=False)
    else:
        scoring.score_table(spark, args.curated, args.bundle, args.out, args.split, args.limit, args.expected_pr_auc).show(truncate=False)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    try:
        run(args)
    except FileNotFoundError as error:
        print(f"riskloom: {error}", file=sys.stderr)
        return 2
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        print(f"riskloom: {error}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
