"""A3: per-class evaluation report of a classifier's predictions.

Rows: one per class (precision, recall, f1, support), then ``accuracy``
(f1 holds the accuracy, support the row count), ``macro avg`` and
``weighted avg``.  A zero denominator gives 0.0, as the usual report does.

The data is reduced to confusion counts, these to sums per class, these to
one row of totals: all aggregations with partial results, nothing collected.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# doubles hold every whole number up to here
_EXACT = float(1 << 53)


def class_text(df: DataFrame, name: str) -> Column:
    """A class value as text; whole fractional numbers print without a
    fraction, so an integer label and a double prediction name the same
    class.  Integers and decimals keep every digit."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        value = col.cast("double")
        whole = (F.abs(value) <= _EXACT) & (value == F.floor(value))
        return F.when(whole, F.floor(value).cast("string")).otherwise(col.cast("string"))
    return col.cast("string")


def confusion_counts(df: DataFrame, label_col: str, prediction_col: str,
                     weight_col: str | None = None) -> DataFrame:
    """Rows per (label, prediction), labels and predictions as text.  With
    ``weight_col`` each row counts that many times (pre-aggregated input)."""
    n = F.count(F.lit(1)) if weight_col is None else F.sum(F.col(weight_col)).cast("long")
    return df.groupBy(
        class_text(df, label_col).alias("label"),
        class_text(df, prediction_col).alias("predicted"),
    ).agg(n.alias("n"))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def per_class(cells: DataFrame) -> DataFrame:
    """``label, support, hits, precision, recall, f1`` from confusion counts;
    a class that is only predicted has no support."""
    none = F.lit(0).cast("long")
    right = F.when(F.col("label").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(none)
    sides = F.array(
        F.struct(F.col("label").alias("label"), F.col("n").alias("support"), none.alias("claimed"), right.alias("hits")),
        F.struct(F.col("predicted").alias("label"), none.alias("support"), F.col("n").alias("claimed"), none.alias("hits")))
    sums = cells.select(F.inline(sides)).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hits").alias("hits"))
    rated = sums.withColumn("precision", _ratio(F.col("hits"), F.col("claimed"))).withColumn(
        "recall", _ratio(F.col("hits"), F.col("support")))
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1", _ratio(2 * p * r, p + r)).drop("claimed")


def summary_rows(classes: DataFrame) -> DataFrame:
    """The three summary rows from the per-class rows."""
    measures = ["precision", "recall", "f1"]
    folded = classes.agg(
        F.coalesce(F.sum("support"), F.lit(0)).alias("total"), F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("k"),
        *[F.sum(m).alias(f"sum_{m}") for m in measures],
        *[F.sum(F.col(m) * F.col("support")).alias(f"weighted_{m}") for m in measures])
    total, k, empty = F.col("total"), F.col("k"), F.lit(None).cast("double")

    def row(label: str, values: list[Column]) -> Column:
        return F.struct(F.lit(label).alias("label"), *[v.alias(m) for m, v in zip(measures, values)],
                        total.alias("support"))

    return folded.select(F.inline(F.array(
        row("accuracy", [empty, empty, _ratio(F.col("hits"), total)]),
        row("macro avg", [_ratio(F.col(f"sum_{m}"), k) for m in measures]),
        row("weighted avg", [_ratio(F.col(f"weighted_{m}"), total) for m in measures]))))


def classification_report(
    df: DataFrame,
    label_col: str,
    prediction_col: str = "prediction",
    *,
    target_names: Mapping[str, str] | None = None,
    digits: int = 6,
    weight_col: str | None = None,
) -> DataFrame:
    """Precision, recall, f1 and support per class plus summary rows
    (``label, precision, recall, f1, support``), lazily.  ``target_names``
    replaces class names in the class rows."""
    classes = per_class(confusion_counts(df, label_col, prediction_col, weight_col))
    name = F.col("label")
    if target_names:
        pairs = [F.lit(x) for k, v in target_names.items() for x in (str(k), v)]
        name = F.coalesce(F.element_at(F.create_map(*pairs), name), name)
    rows = classes.select(name.alias("label"), "precision", "recall", "f1", "support").unionByName(summary_rows(classes))
    return rows.select("label", *[F.round(m, digits).alias(m) for m in ("precision", "recall", "f1")],
                       F.col("support").cast("long").alias("support"))
