"""Timelines embedded in HTML pages, and their means.

A streaming statistics page holds its charts as JavaScript arrays, e.g.
``var v1 = [{x: "15:13:19", y: 5.0}, ...];`` with unquoted keys.  The
page is cut where the array begins, and the JSON reader, with
``allowUnquotedFieldNames``, reads it up to its own end - so strings with any
brackets and marks in them survive; points are exploded and averaged per
metric.  Pages are ordinary rows, so any number of them is processed in
parallel and the means use partial aggregation.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Chart variables of the streaming statistics page and the
# metric each one holds.
TIMELINE_METRICS = {
    "Input Rate (records/sec)": "v1",
    "Process Rate (records/sec)": "v2",
    "Input Rows (records/batch)": "v3",
    "Batch Duration (ms)": "v4",
}
OPERATION_VAR = "v5"

READ_OPTIONS = {"allowUnquotedFieldNames": "true", "allowUnquotedControlChars": "true"}
POINTS = "array<struct<x:string,y:string>>"


def script_array_text(html: Column, var_name: str) -> Column:
    """Text of the array assigned by ``var NAME = [...];`` ('' if absent)."""
    return F.regexp_extract(html, rf"(?s)\bvar\s+{re.escape(var_name)}\s*=\s*(\[.*?\])\s*;", 1)


def script_array_start(html: Column, var_name: str) -> Column:
    """The page from the array assigned by ``var NAME = [`` on ('' if absent):
    a JSON reader stops where the array ends."""
    return F.regexp_extract(html, rf"(?s)\bvar\s+{re.escape(var_name)}\s*=\s*(\[.*)", 1)


def script_array(html: Column, var_name: str) -> Column:
    """Text of the array assigned by ``var NAME = [...];`` (null if absent)."""
    text = script_array_text(html, var_name)
    return F.when(text != "", text)


def _charts(pages: DataFrame, html_col: str, var_names) -> DataFrame:
    """One projection that cuts every chart's text out of the page, so each
    regular expression runs once per page (the consumers refer to it)."""
    return pages.select(*[script_array_start(F.col(html_col), v).alias(f"__chart_{v}") for v in var_names])


def script_value(html: Column, var_name: str) -> Column:
    """Raw text assigned to ``var NAME`` up to the next ``;`` (null if absent)."""
    text = F.regexp_extract(html, rf"(?s)var {re.escape(var_name)}\s*=\s*(.*?);", 1)
    return F.when(text != "", text)


def call_argument(html: Column, function: str) -> Column:
    """Argument text of the first call ``function(...)`` (null if absent)."""
    text = F.regexp_extract(html, rf"{re.escape(function)}\(([^)]*)\)", 1)
    return F.when(text != "", text)


def timeline_points(pages: DataFrame, *, html_col: str = "html",
                    metrics: Mapping[str, str] = TIMELINE_METRICS) -> DataFrame:
    """One row per chart point: ``metric``, ``x``, ``y`` (double).  A page
    without a chart gives one row with null ``x``/``y`` for it."""
    charts = _charts(pages, html_col, list(dict.fromkeys(metrics.values())))

    def txt(var):
        c = F.col(f"__chart_{var}")
        return F.when(c != "", c)

    entries = F.array(*[
        F.struct(F.lit(name).alias("metric"), txt(var).alias("txt")) for name, var in metrics.items()
    ])
    per_chart = charts.select(F.explode(entries).alias("e"))
    points = per_chart.select(
        F.col("e.metric").alias("metric"),
        F.explode_outer(F.from_json(F.col("e.txt"), POINTS, READ_OPTIONS)).alias("p"),
    )
    return points.select("metric", F.col("p.x").alias("x"), F.col("p.y").try_cast("double").alias("y"))


def timeline_means(pages: DataFrame, *, html_col: str = "html",
                   metrics: Mapping[str, str] = TIMELINE_METRICS, decimals: int | None = None) -> DataFrame:
    """Mean of every chart over all pages; null for a missing chart."""
    mean = F.avg("y")
    if decimals is not None:
        mean = F.round(mean, decimals)
    return timeline_points(pages, html_col=html_col, metrics=metrics).groupBy("metric").agg(
        mean.alias("mean"), F.count("y").alias("n_points")
    )


def operation_means(pages: DataFrame, *, html_col: str = "html", var_name: str = OPERATION_VAR,
                    decimals: int = 2) -> DataFrame:
    """Mean duration per operation from the ``{x, op1, op2, ...}`` chart."""
    chart = F.col(f"__chart_{var_name}")
    arr = F.from_json(F.when(chart != "", chart), "array<map<string,string>>", READ_OPTIONS)
    entries = _charts(pages, html_col, [var_name]).select(F.explode(arr).alias("m"))
    ops = entries.select(F.explode("m").alias("operation", "v")).filter(F.col("operation") != "x")
    return ops.groupBy("operation").agg(
        F.round(F.avg(F.col("v").try_cast("double")), decimals).alias("mean_ms")
    )


def unquote_keys(json_text: Column) -> Column:
    """Drop the quotes around object keys (the page's JavaScript style)."""
    return F.regexp_replace(json_text, r'"([A-Za-z_][A-Za-z0-9_]*)":', "$1:")
