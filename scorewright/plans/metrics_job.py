"""Streaming statistics pages -> chart means, as a Spark job.

``python -m scorewright.plans.metrics_job --pages "/saved/ui/*.html"``

Every saved page is one row (whole-text read); the four timelines and the
per-operation chart are cut out and averaged over all pages.  Prints one
JSON object: ``{"means": {metric: mean}, "operations": {operation: ms}}``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from ..operators.timeline import operation_means, timeline_means
from ..sources.files import read_documents


def summarize_pages(spark: SparkSession, pages_glob: str, *, decimals: int = 2) -> dict:
    pages = read_documents(spark, pages_glob)
    means = {r["metric"]: r["mean"] for r in timeline_means(pages, decimals=decimals).collect()}
    ops = {r["operation"]: r["mean_ms"] for r in operation_means(pages, decimals=decimals).collect()}
    return {"means": means, "operations": ops}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="chart means of saved streaming statistics pages")
    ap.add_argument("--pages", required=True, help="file, folder or glob of saved pages")
    ap.add_argument("--decimals", type=int, default=2)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("scorewright-metrics").getOrCreate()
    print(json.dumps(summarize_pages(spark, args.pages, decimals=args.decimals), sort_keys=True))
    return 0


if __name__ == "__main__":  # pragma: no cover
    raise SystemExit(main())
