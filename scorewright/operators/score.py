"""Model scoring: one prediction per row, on batch and stream alike.

Two routes, chosen by ``model_config["type"]``:

* ``spark_mllib`` - a saved ``PipelineModel``; features are assembled into a
  vector and the model's own ``transform`` runs in the JVM.
* any other type - a Python model with a ``predict`` method, run by an
  iterator pandas UDF: the model is loaded once per task and then scores
  many Arrow batches.  The features cross the Python boundary as one
  struct column, i.e. one pandas DataFrame per batch (no per-row objects).

Python loaders live in a registry (``register_loader``) keyed by type name;
``sklearn``/``joblib``/``pickle`` read a pickled object, ``tensorflow`` needs its
package on the workers.  ``xgboost_native`` with a JSON model file is compiled
into column expressions and needs no package; its binary files do.  A model
object can also be given directly; it is shipped once per executor as a
broadcast.  Paths with a scheme (``hdfs://``, ``s3a://``, ``dbfs:/``, ...) are
read once, on the driver, by the session's own file systems and shipped.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, IntegerType, NumericType

from ..functions.casts import parse_type
from ..session import ship_package
from .trees import booster_from_json, forest_from_saved, score_booster, score_forest

# --------------------------------------------------------------------------
# loader registry
# --------------------------------------------------------------------------

Loader = Callable[[str], Any]
Predictor = Callable[[Any, pd.DataFrame], Any]


def _load_pickle(path: str) -> Any:
    try:
        import joblib  # type: ignore

        return joblib.load(path)
    except ImportError:
        with open(path, "rb") as fh:
            return pickle.load(fh)


def _load_xgboost(path: str) -> Any:
    try:
        import xgboost as xgb  # type: ignore
    except ImportError as exc:
        raise ImportError("model type 'xgboost_native' needs the xgboost package on every worker") from exc
    booster = xgb.Booster()
    booster.load_model(path)
    return booster


def _predict_xgboost(model: Any, features: pd.DataFrame) -> Any:
    import xgboost as xgb  # type: ignore

    return model.predict(xgb.DMatrix(features))


def _load_tensorflow(path: str) -> Any:
    try:
        from tensorflow.keras.models import load_model  # type: ignore
    except ImportError as exc:
        raise ImportError("model type 'tensorflow' needs tensorflow on every worker") from exc
    return load_model(path)


def _predict_default(model: Any, features: pd.DataFrame) -> Any:
    return model.predict(features)


# fixed values: the flavour names of job files
_LOADERS: dict[str, tuple[Loader, Predictor]] = {
    "sklearn": (_load_pickle, _predict_default),
    "joblib": (_load_pickle, _predict_default),
    "pickle": (_load_pickle, _predict_default),
    "xgboost_native": (_load_xgboost, _predict_xgboost),
    "tensorflow": (_load_tensorflow, _predict_default),
}


def register_loader(type_name: str, load: Loader, predict: Predictor = _predict_default) -> None:
    """Register a Python model flavour: ``load(path) -> model`` and
    ``predict(model, features_frame) -> array``."""
    _LOADERS[type_name] = (load, predict)


def loader_for(type_name: str) -> tuple[Loader, Predictor]:
    """Loader and predictor of a type; unknown names fall back to pickle."""
    return _LOADERS.get(type_name, _LOADERS["pickle"])


# --------------------------------------------------------------------------
# rule models (plain Python models usable in tests and queries)
# --------------------------------------------------------------------------


class ThresholdRule:
    """``predict`` gives 1 where ``feature`` is above ``threshold``, else 0."""

    def __init__(self, feature: str, threshold: float, *, inclusive: bool = False):
        self.feature = feature
        self.threshold = threshold
        self.inclusive = inclusive

    def predict(self, features: pd.DataFrame) -> np.ndarray:
        x = features[self.feature].to_numpy(dtype="float64")
        hit = x >= self.threshold if self.inclusive else x > self.threshold
        return hit.astype("int32")


class CategoryRule:
    """``predict`` gives 1 where ``feature`` is one of ``values``, else 0."""

    def __init__(self, feature: str, values):
        self.feature = feature
        self.values = set(values)

    def predict(self, features: pd.DataFrame) -> np.ndarray:
        return features[self.feature].isin(self.values).to_numpy().astype("int32")


class LinearScore:
    """``predict`` gives ``sum(w_i * x_i) + bias`` as a float score."""

    def __init__(self, weights: Mapping[str, float], bias: float = 0.0):
        self.weights = dict(weights)
        self.bias = bias

    def predict(self, features: pd.DataFrame) -> np.ndarray:
        total = np.full(len(features), self.bias, dtype="float64")
        for name, w in self.weights.items():
            total += w * features[name].to_numpy(dtype="float64")
        return total


# --------------------------------------------------------------------------
# prediction post-processing
# --------------------------------------------------------------------------


def _as_result(pred: Any, n: int, result_type: DataType, threshold: float | None,
               output_index: int | None = None) -> pd.Series:
    """One prediction per row.  Several outputs per row need an index; a
    missing score (NaN) has no class; what a type cannot hold is an error."""
    arr = np.asarray(pred)
    if arr.ndim > 1:
        arr = arr.reshape(len(arr), -1)
        if output_index is not None:
            arr = arr[:, output_index]
        elif arr.shape[1] == 1:  # e.g. (n, 1) from a Keras model
            arr = arr[:, 0]
        else:
            raise ValueError(f"model returned {arr.shape[1]} values per row; set 'output_index'")
    if len(arr) != n:
        raise ValueError(f"model returned {len(arr)} predictions for {n} rows")
    if threshold is not None:
        scores = arr.astype("float64")
        return pd.Series(scores >= threshold).astype("Int32").mask(np.isnan(scores))
    if isinstance(result_type, IntegerType):
        if arr.dtype.kind == "f":
            finite = arr[~np.isnan(arr)]
            if finite.size and not np.all(np.equal(np.mod(finite, 1), 0)):
                raise ValueError(
                    "model returned fractional scores for an integer prediction; "
                    "set 'threshold' or 'result_type: double'"
                )
            arr, missing = np.where(np.isnan(arr), 0, arr), np.isnan(arr)
        else:
            missing = np.zeros(len(arr), dtype=bool)
        if len(arr) and (arr.min() < -(1 << 31) or arr.max() >= 1 << 31):
            raise ValueError("a prediction does not fit an integer; set 'result_type: double'")
        return pd.Series(arr.astype("int32")).astype("Int32").mask(missing)
    return pd.Series(arr.astype("float64"))


# --------------------------------------------------------------------------
# Python route
# --------------------------------------------------------------------------


# Models read from a path, kept per Python worker process: with worker
# reuse (Spark's default) a model is read once per process, not per task.
_LOADED: dict[tuple, Any] = {}


def cached_load(load: Loader, type_name: str, path: str) -> Any:
    """Load ``path``, once per process (keyed by path, size and modification
    time, so a replaced file is read again)."""
    import os

    try:
        st = os.stat(path)
        stamp = (st.st_size, st.st_mtime_ns)
    except OSError:
        stamp = None
    key = (type_name, path, stamp)
    if key not in _LOADED:
        _LOADED[key] = load(path)
    return _LOADED[key]


def _by_value(fn: Callable) -> bytes:
    """A function as bytes that workers can read without the module that
    defines it (a script, a notebook or a test)."""
    import inspect
    import sys

    from pyspark import cloudpickle

    module = inspect.getmodule(fn)
    own = module is not None and module.__name__.split(".")[0] != __name__.split(".")[0]
    shippable = own and module.__name__ in sys.modules and not hasattr(module, "__path__") and \
        "site-packages" not in (getattr(module, "__file__", None) or "site-packages")
    if shippable:
        cloudpickle.register_pickle_by_value(module)
    try:
        return cloudpickle.dumps(fn)
    finally:
        if shippable:
            cloudpickle.unregister_pickle_by_value(module)


def _ship(spark: SparkSession, path: str) -> str:
    """Copy a model file or folder to every executor under a name that tells
    its content, so that files of one base name do not meet; returns the
    name."""
    import atexit
    import hashlib
    import os
    import shutil
    import tempfile

    # staged on the driver only, until it ends; Spark's file server hands it out
    folder = tempfile.mkdtemp(prefix="scorewright-model-")
    atexit.register(shutil.rmtree, folder, True)
    if _SCHEME.match(path):
        path = _local_copy(spark, path, os.path.realpath(folder))
    digest = hashlib.sha256()
    files = [path] if os.path.isfile(path) else sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names)
    for file in files:
        digest.update(os.path.relpath(file, path).encode("utf-8"))
        with open(file, "rb") as fh:
            digest.update(fh.read())
    name = f"{digest.hexdigest()[:24]}-{os.path.basename(path.rstrip('/'))}"
    shipped = _SHIPPED_FILES.setdefault(spark.sparkContext.applicationId, {})
    if name not in shipped:
        shipped[name] = os.path.join(folder, name)
        if os.path.isdir(path):
            shutil.copytree(path, shipped[name])
        else:
            shutil.copyfile(path, shipped[name])
        spark.sparkContext.addFile(shipped[name], recursive=os.path.isdir(path))
    return name


_SHIPPED_FILES: dict[str, dict[str, str]] = {}

_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]+:/")


def _local_copy(spark: SparkSession, path: str, folder: str) -> str:
    """A model on any file system that the session knows, as a file or
    folder below ``folder`` on the driver."""
    import os

    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    source, target = hadoop(path), os.path.join(folder, path.rstrip("/").rsplit("/", 1)[-1])
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(source):
        raise FileNotFoundError(path)
    fs.copyToLocalFile(False, source, hadoop(f"file://{target}"), True)
    return target


def read_model_text(spark: SparkSession, path: str) -> str:
    """A model file's text, from a plain path or any file system."""
    if not _SCHEME.match(path):
        with open(path, encoding="utf-8") as fh:
            return fh.read()
    import tempfile

    with tempfile.TemporaryDirectory(prefix="scorewright-model-") as folder:
        with open(_local_copy(spark, path, folder), encoding="utf-8") as fh:
            return fh.read()


def _model_source(spark: SparkSession, model_config: Mapping, model: Any):
    """A zero-argument callable, run on the worker, that returns the model."""
    if model is not None:
        try:
            handle = spark.sparkContext.broadcast(model)
            return lambda: handle.value
        except Exception:  # no SparkContext (e.g. Connect): ship in the closure
            return lambda: model
    path = model_config["path"]
    type_name = model_config.get("type", "sklearn")
    # the loader is looked up here: a worker does not know what was registered
    loader = _by_value(loader_for(type_name)[0])
    shipped = _ship(spark, path) if model_config.get("ship", False) or _SCHEME.match(path) else None

    def on_worker():
        where = path
        if shipped is not None:
            from pyspark import SparkFiles

            where = SparkFiles.get(shipped)
        return cached_load(pickle.loads(loader), type_name, where)

    return on_worker


def score(
    df: DataFrame,
    model_config: Mapping,
    *,
    model: Any = None,
    output_col: str = "prediction",
) -> DataFrame:
    """Append a prediction column computed from ``model_config["features"]``.

    Keys of ``model_config``: ``type`` (default ``sklearn``), ``path``,
    ``features`` (order matters), ``result_type`` (``int`` or ``double``),
    ``threshold`` (turns scores into 0/1), ``on_null`` (``keep``: nulls reach
    the model as NaN; ``skip``: rows with a null feature get a null
    prediction), ``output_index`` (which value of a model with several per
    row), ``ship`` (copy ``path`` to every executor with ``addFile``), ``compile`` (``spark_mllib``: a saved forest as
    column expressions), ``with_identity`` (add ``model_name``/``model_version`` literal columns from ``name``/``version``).
    """
    model_type = model_config.get("type", "sklearn")
    features = list(model_config["features"])
    if not features:
        raise ValueError("model configuration needs at least one feature")
    if model_type == "spark_mllib" and model_config.get("compile", False):
        out = score_forest(df, forest_from_saved(df.sparkSession, model_config["path"]), features, output_col=output_col)
    elif model_type == "spark_mllib":
        out = score_mllib(df, model_config, output_col=output_col)
    elif model is None and model_type == "xgboost_native" and str(model_config["path"]).lower().endswith(".json"):
        booster = booster_from_json(read_model_text(df.sparkSession, str(model_config["path"])))
        out = score_booster(df, model_config, booster, output_col=output_col)
    else:
        out = _score_python(df, model_config, model, features, output_col)
    if model_config.get("with_identity", False):
        out = out.withColumn("model_name", F.lit(model_config.get("name")).cast("string"))
        out = out.withColumn("model_version", F.lit(model_config.get("version")).cast("string"))
    return out


def _score_python(df, model_config, model, features, output_col):
    spark = df.sparkSession
    ship_package(spark)
    threshold = model_config.get("threshold")
    result_type = (
        IntegerType() if threshold is not None else parse_type(model_config.get("result_type", "int"))
    )
    if not isinstance(result_type, (IntegerType, DoubleType)):
        raise ValueError("result_type must be 'int' or 'double'")
    on_null = model_config.get("on_null", "keep")
    if on_null not in ("keep", "skip"):
        raise ValueError("on_null must be 'keep' or 'skip'")
    get_model = _model_source(spark, model_config, model)
    predictor = _by_value(loader_for(model_config.get("type", "sklearn"))[1] if model is None else _predict_default)
    output_index = model_config.get("output_index")
    names = list(features)

    @F.pandas_udf(result_type)
    def predict_udf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predict = pickle.loads(predictor)
        mdl = get_model()  # once per task; path models once per worker process
        for frame in batches:
            frame.columns = names
            if on_null == "skip":
                ok = frame.notna().all(axis=1).to_numpy()
                dtype = "float64" if isinstance(result_type, DoubleType) else "Int32"
                result = pd.Series(pd.NA, index=range(len(frame)), dtype=dtype)
                if ok.any():
                    kept = frame[ok].reset_index(drop=True)
                    result[ok] = _as_result(predict(mdl, kept), len(kept), result_type, threshold, output_index).to_numpy()
                yield result
            else:
                yield _as_result(predict(mdl, frame), len(frame), result_type, threshold, output_index)

    # Numbers reach the model as float64 (whatever their Spark type); other
    # features (categories as text, flags) keep their own type.
    def packed_field(i, c):
        dtype = df.schema[c].dataType
        col = F.col(c).cast("double") if isinstance(dtype, (NumericType, BooleanType)) else F.col(c)
        return col.alias(f"f{i}")

    packed = F.struct(*[packed_field(i, c) for i, c in enumerate(names)])
    return df.withColumn(output_col, predict_udf(packed))


# --------------------------------------------------------------------------
# Native Spark ML route
# --------------------------------------------------------------------------


# fixed value: the vector column that saved models expect
VECTOR_COL = "features_vector"


def assemble(df: DataFrame, features: Sequence[str], *, output_col: str = VECTOR_COL,
             handle_invalid: str = "error") -> DataFrame:
    """Pack feature columns into an ML vector column."""
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(inputCols=list(features), outputCol=output_col, handleInvalid=handle_invalid)
    return assembler.transform(df)


def score_mllib(df: DataFrame, model_config: Mapping, *, output_col: str = "prediction",
                pipeline_model: Any = None) -> DataFrame:
    """Score with a saved ``PipelineModel`` (loaded once, on the driver)."""
    from pyspark.ml import PipelineModel

    features = list(model_config["features"])
    pm = pipeline_model if pipeline_model is not None else PipelineModel.load(model_config["path"])
    assembled = assemble(df, features, handle_invalid=model_config.get("handle_invalid", "error"))
    out = pm.transform(assembled)
    if output_col != "prediction":
        out = out.withColumnRenamed("prediction", output_col)
    return out


def feature_array(df: DataFrame, features: Sequence[str], *, output_col: str = "features") -> DataFrame:
    """Pack features into one ``array<double>`` column."""
    return df.withColumn(output_col, F.array(*[F.col(c).cast("double") for c in features]))
