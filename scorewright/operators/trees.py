"""Tree ensembles compiled into column expressions.

A tree becomes one nested CASE expression over the feature columns, an
ensemble the sum of its trees, so scoring runs in the JVM, inside generated
code, without the library that trained the model:

* :func:`booster_from_json` reads a gradient booster's JSON model file (trees
  with default directions for missing values, base score, objective);
* :func:`forest_from_saved` reads the node table of a forest classifier in a
  saved ``PipelineModel``; its compiled votes are the model's own
  ``rawPrediction``, added in the same order.

Nodes are read on the driver: a model, not data.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import free_prefix


@dataclass
class Tree:
    """Nodes by number, 0 the root: children (-1: a leaf), the feature and
    the test of a split, and the values of a leaf."""

    left: Sequence[int]
    right: Sequence[int]
    feature: Sequence[int]
    threshold: Sequence[float]
    values: Sequence[tuple[float, ...]]
    missing_left: Sequence[bool] | None = None
    categories: Mapping[int, tuple[float, ...]] = field(default_factory=dict)  # node -> those that go left
    inclusive: bool = False  # whether the threshold itself goes left

    def sql(self, columns: Sequence[str]) -> str:
        """The tree over feature columns (missing values null) as SQL text."""
        out: dict[int, str] = {}
        todo = [(0, False)]
        while todo:
            node, done = todo.pop()
            left, right = self.left[node], self.right[node]
            if left < 0:
                cells = [_number(v) for v in self.values[node]]
                out[node] = cells[0] if len(cells) == 1 else f"array({', '.join(cells)})"
            elif done:
                x = f"`{columns[self.feature[node]]}`"
                if node in self.categories:
                    test = f"{x} IN ({', '.join(map(_number, self.categories[node]))})"
                else:
                    test = f"{x} {'<=' if self.inclusive else '<'} {_number(self.threshold[node])}"
                if self.missing_left is not None and self.missing_left[node]:
                    test = f"coalesce({test}, true)"
                out[node] = f"CASE WHEN {test} THEN {out.pop(left)} ELSE {out.pop(right)} END"
            else:
                todo += [(node, True), (left, False), (right, False)]
        return out[0]


def _number(value: float) -> str:
    value = float(value)
    if math.isnan(value) or math.isinf(value):
        return f"double('{'NaN' if math.isnan(value) else 'Infinity' if value > 0 else '-Infinity'}')"
    return f"({value!r}D)" if value < 0 else f"{value!r}D"


def _with_features(df: DataFrame, features: Sequence[str], own: str, kind: str) -> tuple[DataFrame, list[str]]:
    """The features as ``own`` columns of a number type, NaN as null."""
    names = [f"{own}x{i}" for i in range(len(features))]
    cells = {}
    for name, feature in zip(names, features):
        x = F.col(f"`{feature}`").cast("double").cast(kind)
        cells[name] = F.when(~F.isnan(x), x).cast("double")
    return df.withColumns(cells), names


def _sum(parts: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for part in parts:
        total = total + part
    return total


# --------------------------------------------------------------------------
# gradient boosters
# --------------------------------------------------------------------------


@dataclass
class Booster:
    """``trees`` with the class that each adds to, the margins they start
    from, and the objective that turns margins into predictions."""

    trees: list[Tree]
    of_class: list[int]
    base: list[float]
    objective: str
    n_features: int


# fixed values: objectives of the model file by the link of their margin
LOGISTIC = ("binary:logistic", "reg:logistic")
EXPONENTIAL = ("count:poisson", "reg:gamma", "reg:tweedie", "survival:cox")
IDENTITY = ("reg:squarederror", "reg:linear", "reg:absoluteerror", "reg:pseudohubererror", "reg:squaredlogerror",
            "binary:logitraw", "rank:pairwise", "rank:ndcg", "rank:map")
CLASSES = ("multi:softprob", "multi:softmax")


def booster_from_json(text: str) -> Booster:
    """Read a JSON model file; what is not built is refused."""
    learner = json.loads(text)["learner"]
    objective = learner["objective"]["name"]
    if objective not in LOGISTIC + EXPONENTIAL + IDENTITY + CLASSES + ("binary:hinge",):
        raise ValueError(f"objective {objective!r} is not built")
    params, booster = learner["learner_model_param"], learner["gradient_booster"]
    weights = None
    if booster["name"] == "dart":
        weights, booster = booster["weight_drop"], booster["gbtree"]
    elif booster["name"] != "gbtree":
        raise ValueError(f"booster {booster['name']!r} has no trees")
    model, trees = booster["model"], []
    for n, raw in enumerate(model["trees"]):
        if any(raw.get("split_type") or ()):
            raise ValueError("categorical splits are not built")
        # the file's numbers are single precision, and so are comparisons
        numbers = [float(v) for v in np.asarray(raw["split_conditions"], dtype=np.float32)]
        scale = 1.0 if weights is None else float(np.float32(weights[n]))
        leaf = [(v * scale,) for v in numbers]
        trees.append(Tree(raw["left_children"], raw["right_children"], raw["split_indices"], numbers, leaf,
                          [bool(d) for d in raw["default_left"]]))
    classes = max(1, int(params.get("num_class", 0)))
    start = params.get("base_score", "0.5")
    start = json.loads(start) if str(start).lstrip().startswith("[") else [float(start)]
    start = [float(s) for s in (start if len(start) == classes else start * classes)]
    if objective in LOGISTIC:
        start = [math.log(s / (1 - s)) for s in start]
    elif objective in EXPONENTIAL:
        start = [math.log(s) for s in start]
    return Booster(trees, [int(c) for c in model["tree_info"]], start, objective, int(params["num_feature"]))


def booster_outputs(booster: Booster, margins: Sequence[Column]) -> list[Column]:
    """Predictions of a row from its margins, one or one per class."""
    if booster.objective in LOGISTIC:
        return [1.0 / (1.0 + F.exp(-margins[0]))]
    if booster.objective in EXPONENTIAL:
        return [F.exp(margins[0])]
    if booster.objective == "binary:hinge":
        return [(margins[0] > 0).cast("double")]
    if booster.objective == "multi:softmax":
        every = F.array(*margins)
        return [(F.array_position(every, F.array_max(every)) - 1).cast("double")]
    if booster.objective == "multi:softprob":
        top = F.greatest(*margins) if len(margins) > 1 else margins[0]
        powers = [F.exp(m - top) for m in margins]
        return [p / _sum(powers) for p in powers]
    return list(margins)


def score_booster(df: DataFrame, model_config: Mapping, booster: Booster, *, output_col: str = "prediction") -> DataFrame:
    """Score by a compiled booster with the keys of a model section:
    ``threshold``, ``result_type``, ``on_null`` and ``output_index`` as for a
    Python model.  Features are compared in single precision as the booster
    does; leaves are added in double precision (scores agree to about seven
    digits).  A null or NaN feature goes each split's default way, or with
    ``on_null: skip`` gives a null prediction."""
    features = list(model_config["features"])
    if len(features) < booster.n_features:
        raise ValueError(f"the model has {booster.n_features} features, the configuration {len(features)}")
    threshold, kind = model_config.get("threshold"), str(model_config.get("result_type", "int"))
    own = free_prefix([*df.columns, output_col])
    rows, names = _with_features(df, features, own, "float")
    per_tree = {f"{own}t{n}": F.expr(tree.sql(names)) for n, tree in enumerate(booster.trees)}
    rows = rows.withColumns(per_tree) if per_tree else rows
    margins = {f"{own}m{c}": F.lit(start) + _sum([F.col(f"{own}t{n}") for n, k in enumerate(booster.of_class) if k == c])
               for c, start in enumerate(booster.base)}
    rows = rows.withColumns(margins)
    outputs = booster_outputs(booster, [F.col(m) for m in margins])
    index = model_config.get("output_index")
    if len(outputs) > 1 and index is None:
        raise ValueError(f"model returned {len(outputs)} values per row; set 'output_index'")
    result = outputs[int(index or 0)]
    if threshold is not None:
        result = (result >= float(threshold)).cast("int")
    elif kind == "int":
        if booster.objective not in ("multi:softmax", "binary:hinge"):
            raise ValueError("model returns fractional scores for an integer prediction; set 'threshold' or 'result_type: double'")
        result = result.cast("int")
    if model_config.get("on_null", "keep") == "skip":
        missing = F.lit(False)
        for name in names[:len(features)]:
            missing = missing | F.col(name).isNull()
        result = F.when(~missing, result)
    return rows.withColumn(output_col, result).drop(*names, *per_tree, *margins)


# --------------------------------------------------------------------------
# saved forests
# --------------------------------------------------------------------------


def forest_from_saved(spark: SparkSession, path: str) -> list[Tree]:
    """The trees of the forest (or tree) classifier in a saved
    ``PipelineModel`` or model; a leaf's values are its class shares."""
    jvm, found = spark._jvm, []
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for pattern in ("stages/*/data", "data"):
        found = [str(s.getPath().toString()) for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, pattern)) or []]
        if found:
            break
    nodes = None
    for folder in found:
        table = spark.read.parquet(folder)
        if "nodeData" in table.columns:
            nodes = table
        elif {"leftChild", "impurityStats"} <= set(table.columns):
            nodes = table.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    if nodes is None:
        raise ValueError(f"{path}: no forest classifier in this model")
    by_tree: dict[int, dict[int, object]] = {}
    for row in nodes.select("treeID", "nodeData.*").toLocalIterator():
        by_tree.setdefault(row["treeID"], {})[row["id"]] = row
    trees = []
    for tree_id in sorted(by_tree):
        rows = [by_tree[tree_id][i] for i in range(len(by_tree[tree_id]))]
        cats, thresholds, features = {}, [], []
        for n, r in enumerate(rows):
            split = r["split"]
            inner = r["leftChild"] >= 0
            features.append(split["featureIndex"] if inner else -1)
            numbers = list(split["leftCategoriesOrThreshold"] or []) if inner else []
            if inner and split["numCategories"] != -1:
                cats[n], numbers = tuple(numbers), [math.nan]
            thresholds.append(numbers[0] if numbers else math.nan)
        shares = [tuple(c / sum(r["impurityStats"]) if sum(r["impurityStats"]) else 0.0 for c in r["impurityStats"]) for r in rows]
        trees.append(Tree([r["leftChild"] for r in rows], [r["rightChild"] for r in rows], features, thresholds, shares,
                          categories=cats, inclusive=True))
    return trees


def score_forest(df: DataFrame, trees: Sequence[Tree], features: Sequence[str], *, output_col: str = "prediction",
                 votes_col: str | None = None) -> DataFrame:
    """The class with the most votes (the first of equals), and with
    ``votes_col`` the votes per class.  A missing value fails every test."""
    own = free_prefix([*df.columns, output_col, *([votes_col] if votes_col else [])])
    rows, names = _with_features(df, features, own, "double")
    rows = rows.withColumns({f"{own}t{n}": F.expr(tree.sql(names)) for n, tree in enumerate(trees)})
    classes = len(trees[0].values[0])
    votes = F.array(*[_sum([F.get(F.col(f"{own}t{n}"), F.lit(c)) for n in range(len(trees))]) for c in range(classes)])
    rows = rows.withColumn(f"{own}votes", votes)
    won = (F.array_position(f"{own}votes", F.array_max(f"{own}votes")) - 1).cast("double")
    out = rows.withColumn(output_col, won)
    if votes_col:
        out = out.withColumn(votes_col, F.col(f"{own}votes"))
    return out.drop(*names, *[f"{own}t{n}" for n in range(len(trees))], f"{own}votes")
