"""Scoring: pickled model files, features by configuration, loader
registry (U2), result types, null handling, native Spark ML route (U3)."""

import pickle

import numpy as np
import pandas as pd
import pytest

from scorewright.operators.score import (
    LinearScore,
    ThresholdRule,
    _as_result,
    loader_for,
    register_loader,
    score,
)
from pyspark.sql.types import DoubleType, IntegerType


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "value")


def as_on_the_driver(out, model, features):
    """Every row's prediction is what the model says of the same rows here."""
    got = out.toPandas()
    assert len(got) == 1000
    np.testing.assert_allclose(got["prediction"].to_numpy(dtype=float), model.predict(got[features]))
    return got


def test_pickled_model_file(spark, events, scratch):
    model, path = ThresholdRule("value", 100.0), f"{scratch}/model.pkl"
    with open(path, "wb") as fh:
        pickle.dump(model, fh)
    out = score(events, {"path": path, "features": ["user_id", "value"]})  # no type: a pickled object
    assert out.columns == [*events.columns, "prediction"] and out.schema["prediction"].dataType == IntegerType()
    assert set(as_on_the_driver(out, model, ["user_id", "value"])["prediction"]) == {0, 1}


def test_features_reach_the_model_in_the_configured_order(spark, events):
    class First:
        def predict(self, features):
            return (features.iloc[:, 0] > features.iloc[:, 1]).to_numpy().astype("int32")

    ones = [score(events, {"features": names}, model=First()).filter("prediction = 1").count()
            for names in (["user_id", "value"], ["value", "user_id"])]
    assert ones == [events.filter("user_id > value").count(), events.filter("value > user_id").count()] and ones[0] != ones[1]


def test_model_object_broadcast(spark, events):
    model = ThresholdRule("value", 50.0, inclusive=True)
    as_on_the_driver(score(events, {"features": ["value"]}, model=model), model, ["value"])


def test_threshold_and_double_results(spark, events):
    model = LinearScore({"value": 0.01, "user_id": -0.002}, bias=0.3)
    cfg = {"features": ["value", "user_id"]}
    got = as_on_the_driver(score(events, {**cfg, "result_type": "double"}, model=model), model, cfg["features"])
    flags = score(events, {**cfg, "threshold": 0.5}, model=model).toPandas()
    assert flags["prediction"].sum() == (got["prediction"] >= 0.5).sum()


def test_fractional_scores_into_int_fail_loudly():
    with pytest.raises(ValueError, match="threshold"):
        _as_result(np.array([0.97, 0.1]), 2, IntegerType(), None)


def test_two_dimensional_predictions_are_flattened():
    out = _as_result(np.array([[1], [0], [1]]), 3, IntegerType(), None)
    assert list(out) == [1, 0, 1]
    two = np.array([[0.2, 0.8], [0.9, 0.1]])
    assert list(_as_result(two, 2, DoubleType(), None, 1)) == [0.8, 0.1]
    assert list(_as_result(two, 2, IntegerType(), 0.5, 0)) == [0, 1]
    with pytest.raises(ValueError, match="output_index"):
        _as_result(two, 2, DoubleType(), None)


def test_missing_and_large_predictions():
    out = _as_result(np.array([0.9, np.nan, 0.1]), 3, IntegerType(), 0.5)
    assert out[0] == 1 and out.isna()[1] and out[2] == 0
    whole = _as_result(np.array([3.0, np.nan]), 2, IntegerType(), None)
    assert whole[0] == 3 and whole.isna()[1]
    for big in (np.array([2**31 + 5]), np.array([float(2**31)]), np.array([-(2**31) - 1])):
        with pytest.raises(ValueError, match="does not fit"):
            _as_result(big, 1, IntegerType(), None)


def test_null_feature_with_threshold_has_no_class(spark):
    df = spark.createDataFrame([(2.0,), (None,)], "a double")
    out = score(df, {"features": ["a"], "threshold": 1.0}, model=LinearScore({"a": 1.0}))
    assert {r["a"]: r["prediction"] for r in out.collect()} == {2.0: 1, None: None}


def test_shipped_files_of_one_name(spark, scratch):
    import os

    df = spark.createDataFrame([(1.0,), (5.0,)], "a double")
    for version, cut in (("v1", 0.0), ("v2", 3.0), ("v3", 9.0)):
        os.makedirs(f"{scratch}/{version}")
        with open(f"{scratch}/{version}/model.pkl", "wb") as fh:
            pickle.dump(ThresholdRule("a", cut), fh)
        df = score(df, {"path": f"{scratch}/{version}/model.pkl", "features": ["a"], "ship": True}, output_col=version)
    assert sorted(map(tuple, df.collect())) == [(1.0, 1, 0, 0), (5.0, 1, 1, 0)]
    assert spark.range(10).count() == 10


def _read_cut(path):
    with open(path) as fh:
        return float(fh.read())


def test_own_flavour_runs_on_workers(spark, scratch):
    with open(f"{scratch}/cut.txt", "w") as fh:
        fh.write("2.5")
    register_loader("cut_file", _read_cut, lambda cut, x: (x["a"] > cut).astype("int32"))
    df = spark.createDataFrame([(1.0,), (5.0,)], "a double")
    out = score(df, {"type": "cut_file", "path": f"{scratch}/cut.txt", "features": ["a"]})
    assert {r["a"]: r["prediction"] for r in out.collect()} == {1.0: 0, 5.0: 1}


def test_null_features_skip(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,)], "depth double")
    out = score(df, {"features": ["depth"], "on_null": "skip"}, model=ThresholdRule("depth", 0.0))
    got = [(r["depth"], r["prediction"]) for r in out.orderBy("depth").collect()]
    assert (None, None) in got and (1.0, 1) in got and (-1.0, 0) in got


def test_loader_registry():
    assert loader_for("sklearn")[0] is loader_for("joblib")[0]
    assert loader_for("something-else")[0] is loader_for("pickle")[0]  # fallback
    register_loader("constant", lambda path: "model", lambda m, x: np.zeros(len(x)))
    load, predict = loader_for("constant")
    assert list(predict(load("p"), pd.DataFrame({"a": [1, 2]}))) == [0, 0]


def test_missing_optional_package_message():
    load, _ = loader_for("xgboost_native")
    try:
        import xgboost  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="xgboost"):
            load("/nonexistent")


def test_identity_columns(spark, events):
    out = score(events, {"features": ["value"], "with_identity": True, "name": "m", "version": "v9"},
                model=ThresholdRule("value", 0.0))
    assert {(r["model_name"], r["model_version"]) for r in out.collect()} == {("m", "v9")}


def test_native_spark_ml_route(spark, scratch):
    from scorewright.operators.score import score_mllib
    from scorewright.operators.train import load_model, save_model, train_random_forest

    rows = [(float(i), float(i % 7), 1 if i % 7 > 3 else 0) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    model = train_random_forest(df, ["a", "b"], "y", num_trees=5, max_depth=3)
    path = save_model(model, f"{scratch}/rf")
    out = score(df, {"type": "spark_mllib", "path": path, "features": ["a", "b"]})
    assert {"features_vector", "rawPrediction", "probability", "prediction"} <= set(out.columns)
    acc = out.filter("prediction = y").count() / out.count()
    assert acc > 0.9
    again = score_mllib(df, {"features": ["a", "b"]}, pipeline_model=load_model(path))
    assert again.count() == 200


def test_shipped_model_file(spark, events, scratch):
    model, path = ThresholdRule("value", 200.0), f"{scratch}/shipped.pkl"
    with open(path, "wb") as fh:
        pickle.dump(model, fh)
    for _ in range(2):  # shipping the same file twice is fine
        as_on_the_driver(score(events, {"path": path, "features": ["value"], "ship": True}), model, ["value"])


def test_cached_load_reads_once(scratch):
    from scorewright.operators import score as S

    path = f"{scratch}/m.pkl"
    with open(path, "wb") as fh:
        pickle.dump(ThresholdRule("a", 1.0), fh)
    load, _ = S.loader_for("pickle")
    first = S.cached_load(load, "pickle", path)
    assert S.cached_load(load, "pickle", path) is first


def test_text_features_keep_their_type(spark):
    from scorewright.operators.score import CategoryRule

    df = spark.createDataFrame([("click", 1), ("error", 2), (None, 3)], "event_type string, n int")
    out = score(df, {"features": ["event_type", "n"]}, model=CategoryRule("event_type", {"error"}))
    assert {r["event_type"]: r["prediction"] for r in out.collect()} == {"click": 0, "error": 1, None: 0}


def test_spark_ml_model_scores_a_stream(spark, scratch):
    from scorewright.operators.train import save_model, train_random_forest
    from scorewright.streaming.sinks import run_until_done, write_stream

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    labelled = events.withColumn("big", (events.value > 100).cast("int"))
    path = save_model(train_random_forest(labelled, ["value"], "big", num_trees=3, max_depth=2), f"{scratch}/m")
    stream = spark.readStream.schema(events.schema).parquet("/root/testdata/sf0.001/events*.parquet")
    scored = score(stream, {"type": "spark_mllib", "path": path, "features": ["value"]})
    sink = {"format": "parquet", "checkpointLocation": f"{scratch}/ck", "options": {"path": f"{scratch}/out"},
            "trigger": {"availableNow": True}}
    run_until_done(write_stream(scored.select("event_id", "value", "prediction"), sink), 600)
    out = spark.read.parquet(f"{scratch}/out")
    assert out.count() == events.count()
    assert out.filter("(value > 100) = (prediction = 1.0)").count() / out.count() > 0.95


def test_null_features_reach_the_model_as_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "depth double")
    out = score(df, {"features": ["depth"]}, model=ThresholdRule("depth", 0.0))  # NaN > 0 is False
    assert sorted((r["depth"] is None, r["prediction"]) for r in out.collect()) == [(False, 1), (True, 0)]
