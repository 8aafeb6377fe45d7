"""A2, K9: model training and persistence with Spark ML.

Training is distributed (tree statistics are aggregated across the
cluster); the model is a ``PipelineModel`` whose stages expect the
assembled ``features_vector`` column, which is what the native scoring
route (:func:`scorewright.operators.score.score_mllib`) builds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .score import assemble


# The forest of the original training step (20 trees,
# depth 5, seed 42).
FOREST_TREES = 20
FOREST_DEPTH = 5
FOREST_SEED = 42


def train_random_forest(train: DataFrame, features: Sequence[str], label_col: str, *,
                        num_trees: int = FOREST_TREES, max_depth: int = FOREST_DEPTH, seed: int = FOREST_SEED,
                        handle_invalid: str = "error"):
    """Fit a random forest (defaults: 20 trees, depth 5, seed 42).  A null
    or NaN feature is an error; ``handle_invalid="skip"`` trains without such
    rows (count them with :func:`invalid_rows`)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier

    data = assemble(train, features, handle_invalid=handle_invalid).withColumn(
        label_col, F.col(label_col).cast("double")
    )
    forest = RandomForestClassifier(
        featuresCol="features_vector", labelCol=label_col, numTrees=num_trees,
        maxDepth=max_depth, seed=seed,
    )
    return Pipeline(stages=[forest]).fit(data)


def invalid_rows(df: DataFrame, features: Sequence[str]) -> int:
    """How many rows have a null or NaN feature."""
    bad = F.lit(False)
    for c in features:
        bad = bad | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    return df.filter(bad).count()


def save_model(model, path: str) -> str:
    """Persist a pipeline model (overwriting)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
