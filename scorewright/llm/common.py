"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# written: a table in the cluster's shared folder, read back; later passes
# neither recompute it nor depend on the executors that made it
from scorewright.session import drop_table as discard  # noqa: F401
from scorewright.session import shared_dir, ship_package  # noqa: F401
from scorewright.session import written_table as written  # noqa: F401

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character untouched."""
    return F.translate(text, UPPER, LOWER)


def row_id() -> Column:
    """An id per row that only orders equal rows.  It is written with the
    table it belongs to before anything depends on it."""
    return F.monotonically_increasing_id()


def temp_name(stem: str) -> str:
    """An internal column name that no input column can have by chance."""
    return f"__{stem}_{uuid.uuid4().hex[:12]}"


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A driver-made table of proven size (a plan, cutoffs, weights)."""
    return spark.createDataFrame(rows, schema)
