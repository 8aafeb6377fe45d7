"""Offline training job: table -> stratified split -> random forest ->
per-class report -> saved model, all as Spark jobs.

``python -m scorewright.plans.train_job --input data.csv --label Class
--model-out /models/rf [--features a,b,c] [--format csv|parquet]``

Without ``--features`` every column but the label is a feature.  The model
is a ``PipelineModel`` that the scoring job loads with
``model: {type: spark_mllib, path: ..., features: [...]}``.  The report is
printed and, with ``--report-out``, written as CSV.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classes import stratified_split
from ..operators.report import classification_report
from ..operators.score import score_mllib
from ..operators.train import invalid_rows, save_model, train_random_forest
from ..session import written_table
from ..sources.files import read_csv_table

log = logging.getLogger(__name__)


def run(spark: SparkSession, table: DataFrame, label: str, model_out: str, *,
        features: list[str] | None = None, key_cols: list[str] | None = None,
        train_percent: int = 80, seed: int = 42, num_trees: int = 20, max_depth: int = 5,
        handle_invalid: str = "error") -> DataFrame:
    """Split, train, evaluate on the held-out rows, save; returns the report.
    A null feature is an error; with ``handle_invalid="skip"`` such rows are
    left out of training and report, and their number is logged."""
    feats = features or [c for c in table.columns if c != label]
    keys = key_cols or feats  # rows are hashed on their content when no key is named
    if handle_invalid == "skip":
        log.warning("%d rows with a null or NaN feature are left out", invalid_rows(table, feats))
    split = stratified_split(table, label, keys, train_percent=train_percent, seed=seed)
    # training takes several passes over its rows: they read what was split once
    split = written_table(split.select(*dict.fromkeys([*feats, label]), "split"), "train-split")
    train = split.filter(F.col("split") == "train").drop("split")
    test = split.filter(F.col("split") == "test").drop("split")
    model = train_random_forest(train, feats, label, num_trees=num_trees, max_depth=max_depth, seed=seed,
                                handle_invalid=handle_invalid)
    save_model(model, model_out)
    scored = score_mllib(test, {"features": feats, "handle_invalid": handle_invalid}, pipeline_model=model)
    return classification_report(scored, label, "prediction")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="train a random forest on a labelled table")
    ap.add_argument("--input", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--label", required=True)
    ap.add_argument("--features", default=None, help="comma-separated; default: all but the label")
    ap.add_argument("--keys", default=None, help="comma-separated row key for the split")
    ap.add_argument("--model-out", required=True)
    ap.add_argument("--report-out", default=None)
    ap.add_argument("--train-percent", type=int, default=80)
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--num-trees", type=int, default=20)
    ap.add_argument("--max-depth", type=int, default=5)
    ap.add_argument("--handle-invalid", default="error", choices=["error", "skip", "keep"])
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName("scorewright-train").getOrCreate()
    if args.format == "csv":
        table = read_csv_table(spark, args.input, infer_schema=True)
    else:
        table = spark.read.parquet(args.input)
    report = run(
        spark, table, args.label, args.model_out,
        features=args.features.split(",") if args.features else None,
        key_cols=args.keys.split(",") if args.keys else None,
        train_percent=args.train_percent, seed=args.seed,
        num_trees=args.num_trees, max_depth=args.max_depth, handle_invalid=args.handle_invalid,
    )
    rows = [r.asDict() for r in report.collect()]
    print(json.dumps(rows, indent=1))
    if args.report_out:
        report.coalesce(1).write.mode("overwrite").option("header", "true").csv(args.report_out)
    return 0


if __name__ == "__main__":  # pragma: no cover
    raise SystemExit(main())
