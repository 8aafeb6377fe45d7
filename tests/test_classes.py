"""Class counts, stratified split (A1), rebalancing (A5) and the report (A3),
checked against brute force on small fixtures."""

import hashlib
import math

import pandas as pd
import pytest

from scorewright.operators import classes as C
from scorewright.operators.report import classification_report


def _h32(seed, key):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16)


@pytest.fixture()
def skewed(spark):
    # class 0 holds most rows, class 2 a handful, plus a null class
    rows = [(i, 0 if i % 10 else (1 if i % 20 else 2)) for i in range(1, 2001)] + [(5000 + i, None) for i in range(7)]
    return spark.createDataFrame(rows, "key long, label int")


def test_split_matches_brute_force(spark, skewed):
    out = C.stratified_split(skewed, "label", ["key"], train_percent=80, seed=7).toPandas()
    src = skewed.toPandas()
    src["h"] = [_h32(7, k) for k in src.key]
    for label, grp in src.groupby(src.label.fillna(-1)):
        quota = (len(grp) * 80) // 100
        train = set(grp.sort_values(["h", "key"]).key.iloc[:quota])
        got = set(out[(out.label.fillna(-1) == label) & (out.split == "train")].key)
        assert got == train
    assert len(out) == len(src)


def test_split_with_a_hot_duplicate_key(spark):
    # one key repeated: the hot group still gets its exact quota
    rows = [(1, 0)] * 500 + [(i, 0) for i in range(2, 502)]
    df = spark.createDataFrame(rows, "key long, label int")
    out = C.stratified_split(df, "label", ["key"], train_percent=80, seed=1)
    assert out.filter("split = 'train'").count() == 800
    assert out.count() == 1000


def test_split_percent_bounds(spark, skewed):
    assert C.stratified_split(skewed, "label", ["key"], train_percent=100).filter("split = 'test'").count() == 0
    assert C.stratified_split(skewed, "label", ["key"], train_percent=0).filter("split = 'train'").count() == 0


def test_rebalance_matches_formula(spark, skewed):
    shares = {0: 0.5, 1: 0.3, 2: 0.2, None: 0.0}
    out = C.rebalance(skewed, "label", shares, ["key"], seed=3).toPandas()
    src = skewed.toPandas()
    counts = src.label.fillna(-1).value_counts().to_dict()
    n = len(src)
    expect = 0
    for key, label in zip(src.key, src.label.fillna(-1)):
        w = {0: 0.5, 1: 0.3, 2: 0.2, -1: 0.0}[label] * n / counts[label]
        expect += math.floor(w + _h32(3, key) / 4294967296.0)
    assert len(out) == expect
    # copies are numbered 1..k without gaps
    per = out.groupby("key")["copy"].agg(["min", "max", "count"])
    assert (per["min"] == 1).all() and (per["max"] == per["count"]).all()


def test_rebalance_spreads_heavy_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "COPY_RUN", 10)
    df = spark.createDataFrame([(1, 1)] + [(i, 0) for i in range(2, 101)], "key long, label int")
    out = C.rebalance(df, "label", {0: 0.5, 1: 0.5}, ["key"])
    heavy = out.filter("key = 1").toPandas()
    assert len(heavy) in (50, 51)
    assert sorted(heavy["copy"]) == list(range(1, len(heavy) + 1))


def test_rebalance_needs_every_share(spark, skewed):
    with pytest.raises(ValueError, match="share"):
        C.rebalance(skewed, "label", {0: 1.0}, ["key"])


def test_class_counts_and_filter(spark, skewed):
    counts = {r["label"]: (r["n_rows"], r["share"]) for r in C.class_counts(skewed, "label").collect()}
    assert counts[2] == (100, round(100 / 2007, 6))
    assert C.filter_class(skewed, "label", None).count() == 7
    feats, label = C.split_features_label(skewed, "label")
    assert feats.columns == ["key"] and label.columns == ["label"]


def test_report_against_hand_counts(spark):
    truth = [1, 1, 1, 0, 0, 0, 0, 2]
    pred = [1.0, 0.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.0]
    df = spark.createDataFrame(list(zip(truth, pred)), "y int, p double")
    rep = {r["label"]: r for r in classification_report(df, "y", "p").collect()}
    # class 1: tp=2, predicted=3, support=3
    assert rep["1"]["precision"] == round(2 / 3, 6) and rep["1"]["recall"] == round(2 / 3, 6)
    # class 0: tp=3, predicted=5, support=4
    p0, r0 = 3 / 5, 3 / 4
    assert rep["0"]["f1"] == round(2 * p0 * r0 / (p0 + r0), 6)
    # class 2 is never predicted: precision 0 by convention
    assert rep["2"]["precision"] == 0.0 and rep["2"]["support"] == 1
    assert rep["accuracy"]["f1"] == round(5 / 8, 6) and rep["accuracy"]["support"] == 8
    f1s = [rep[c]["f1"] for c in ("0", "1", "2")]
    assert abs(rep["macro avg"]["f1"] - sum(f1s) / 3) < 1e-6


def _brute_force_split(spark, df, key, percent, seed):
    """Expected (key, payload, split) multiset from a full sort."""
    from pyspark.sql import functions as F

    pdf = df.withColumn("rh", F.xxhash64(*[F.col(c) for c in df.columns])).toPandas()
    pdf["h"] = [_h32(seed, k) for k in pdf[key]]
    pdf["rhu"] = pdf.rh.astype("int64").astype("uint64")
    pdf = pdf.sort_values(["h", key, "rhu"], kind="stable").reset_index(drop=True)
    quota = (len(pdf) * percent) // 100
    pdf["split"] = ["train" if i < quota else "test" for i in range(len(pdf))]
    return sorted(zip(pdf[key], pdf.payload, pdf.split)), pdf


@pytest.mark.parametrize("target", ["hot_distinct", "identical"])
def test_split_boundary_inside_hot_key(spark, target):
    """A hot key (half of all rows) whose rows are partly identical: the
    quota is made to end inside it, so every level of the split runs."""
    rows = [(k, k * 10) for k in range(1000, 1500)]                 # unique keys
    rows += [(7, i) for i in range(300)]                              # hot key, distinct rows
    rows += [(7, -1)] * 200                                           # hot key, identical rows
    df = spark.createDataFrame(rows, "key long, payload long").withColumn("label", __import__(
        "pyspark.sql.functions", fromlist=["lit"]).lit(0)).repartition(4)
    df = spark.createDataFrame(df.collect(), df.schema).repartition(4)
    seed = 5
    _, order = _brute_force_split(spark, df, "key", 80, seed)
    hot = order.index[order.key == 7]
    same = order.index[(order.key == 7) & (order.payload == -1)]
    block = same if target == "identical" else hot.difference(same)
    # a percent whose quota falls strictly inside the chosen block
    percent = next(p for p in range(1, 100)
                   if block.min() < (len(order) * p) // 100 < block.max() and
                   ((len(order) * p) // 100) - 1 in block)
    expected, _ = _brute_force_split(spark, df, "key", percent, seed)
    got = C.stratified_split(df, "label", ["key"], train_percent=percent, seed=seed)
    assert sorted(tuple(r) for r in got.select("key", "payload", "split").collect()) == expected


def test_report_weights_equal_repeated_rows(spark):
    rows = [(1, 1.0), (1, 0.0), (0, 0.0), (0, 0.0), (0, 1.0)]
    plain = classification_report(spark.createDataFrame(rows, "y int, p double"), "y", "p").collect()
    agg = spark.createDataFrame([(1, 1.0, 1), (1, 0.0, 1), (0, 0.0, 2), (0, 1.0, 1)], "y int, p double, w long")
    weighted = classification_report(agg, "y", "p", weight_col="w").collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, weighted))


def test_rebalance_total_rows(spark, skewed):
    out = C.rebalance(skewed, "label", {0: 0.5, 1: 0.25, 2: 0.25, None: 0.0}, ["key"], total_rows=4000)
    counts = {r["label"]: r["n_rows"] for r in C.class_counts(out, "label", with_share=False).collect()}
    # floor(w + u) hits the target in expectation: allow four standard deviations
    for label, target in ((0, 2000), (1, 1000), (2, 1000)):
        n = {0: 1800, 1: 100, 2: 100}[label]
        frac = (target / n) % 1
        assert abs(counts[label] - target) <= 4 * (n * frac * (1 - frac)) ** 0.5 + 1
    assert None not in counts


def test_report_target_names(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 0)], "y int, p int")
    labels = {r["label"] for r in classification_report(df, "y", "p", target_names={0: "kept", 1: "sent back"}).collect()}
    assert labels == {"kept", "sent back", "accuracy", "macro avg", "weighted avg"}


def test_report_keeps_labels_beyond_doubles_apart(spark):
    big = 1 << 53
    df = spark.createDataFrame([(big, big + 1), (big + 1, big)], "y long, p long")
    rep = {r["label"]: r for r in classification_report(df, "y", "p").collect()}
    assert rep["accuracy"]["f1"] == 0.0 and rep["accuracy"]["support"] == 2
    assert {str(big), str(big + 1)} <= set(rep)


def test_report_of_no_rows(spark):
    df = spark.createDataFrame([], "y int, p int")
    assert {r["label"]: r["support"] for r in classification_report(df, "y", "p").collect()} == {
        "accuracy": 0, "macro avg": 0, "weighted avg": 0}


@pytest.mark.parametrize("percent", [10, 37, 50, 81, 99])
def test_split_with_null_keys(spark, percent):
    rows = [(None, i) for i in range(300)] + [(k, -1) for k in range(300)] + [(None, 5)] * 100
    df = spark.createDataFrame(rows, "key long, payload long").withColumn("label", __import__(
        "pyspark.sql.functions", fromlist=["lit"]).lit(1)).repartition(3)
    out = C.stratified_split(df, "label", ["key"], train_percent=percent, seed=11)
    assert out.count() == 700
    assert out.filter("split = 'train'").count() == (700 * percent) // 100
    back = sorted((r["key"] if r["key"] is not None else -9, r["payload"]) for r in out.collect())
    assert back == sorted((k if k is not None else -9, p) for k, p in rows)


def test_rebalance_exact_counts(spark, skewed):
    shares = {0: 0.6, 1: 0.25, 2: 0.15, None: 0.0}
    out = C.rebalance(skewed, "label", shares, ["key"], total_rows=3001, exact=True)
    counts = {r["label"]: r["n_rows"] for r in C.class_counts(out, "label", with_share=False).collect()}
    assert counts == {0: int(0.6 * 3001 + 0.5), 1: int(0.25 * 3001 + 0.5), 2: int(0.15 * 3001 + 0.5)}
    per = out.toPandas().groupby("key")["copy"].agg(["min", "max", "count"])
    assert (per["min"] == 1).all() and (per["max"] == per["count"]).all()


def test_hundreds_of_classes(spark):
    rows = [(k, k % 200) for k in range(6000)]
    df = spark.createDataFrame(rows, "key long, label long")
    out = C.stratified_split(df, "label", ["key"], train_percent=70, seed=3).toPandas()
    src = pd.DataFrame(rows, columns=["key", "label"])
    src["h"] = [_h32(3, k) for k in src.key]
    for label, grp in src.groupby("label"):
        quota = (len(grp) * 70) // 100
        expect = set(grp.sort_values(["h", "key"]).key.iloc[:quota])
        assert set(out[(out.label == label) & (out.split == "train")].key) == expect
    shares = {c: 1 / 200 for c in range(200)}
    reb = C.rebalance(df, "label", shares, ["key"], total_rows=8000, exact=True)
    counts = {r["label"]: r["n_rows"] for r in C.class_counts(reb, "label", with_share=False).collect()}
    assert set(counts.values()) == {40}


def test_thousands_of_classes(spark):
    n = 12_000
    df = spark.range(5 * n).selectExpr("id AS key", f"id % {n} AS label")
    out = C.stratified_split(df, "label", ["key"], train_percent=60, seed=3)
    counts = out.groupBy("label", "split").count().toPandas()
    assert set(counts[counts.split == "train"]["count"]) == {3} and set(counts[counts.split == "test"]["count"]) == {2}
    assert len(counts) == 2 * n
    reb = C.rebalance(df, "label", {c: 1 / n for c in range(n)}, ["key"], total_rows=2 * n, exact=True)
    assert reb.groupBy("label").count().groupBy("count").count().collect() == [(2, n)]


def test_hot_class_with_identical_rows(spark):
    rows = [(None, "x")] * 3000 + [(k, "y") for k in range(100)]
    df = spark.createDataFrame(rows, "key long, label string").repartition(7)
    out = C.stratified_split(df, "label", ["key"], train_percent=33)
    assert out.filter("split = 'train' AND label = 'x'").count() == 990
    assert out.filter("split = 'train' AND label = 'y'").count() == 33


def test_select_first_with_partial_take_dict(spark):
    rows = [(k, k % 3) for k in range(300)]
    df = spark.createDataFrame(rows, "key long, label long")
    out = C.select_first(df, "label", ["key"], {0: 10, 1: 1000}, seed=9, flag_col="pick")
    got = {r["label"]: r["n"] for r in out.filter("pick").groupBy("label").count()
           .withColumnRenamed("count", "n").collect()}
    assert got == {0: 10, 1: 100}  # class 2 is not in the dict: none; class 1 asks for more than it has
    assert out.count() == 300


CLASHING = ["_h", "_rh", "_rz", "_rid", "_cut", "_class", "_copies", "_run", "_take", "_n", "_rows", "__sw_h", "__sw_copies", "_train"]


def test_columns_named_like_internal_ones_survive(spark):
    rows = [(k, k % 3, *range(k, k + len(CLASHING))) for k in range(90)] + [(7, 1, *range(len(CLASHING)))] * 20
    df = spark.createDataFrame(rows, ["key", "label", *CLASHING])
    split = C.stratified_split(df, "label", ["key"], train_percent=45)
    assert split.columns == [*df.columns, "split"]
    assert sorted(tuple(r)[:-1] for r in split.collect()) == sorted(rows)
    for exact in (False, True):
        out = C.rebalance(df, "label", {0: 0.2, 1: 0.5, 2: 0.3}, ["key"], exact=exact)
        assert out.columns == [*df.columns, "copy"] and {tuple(r)[:-1] for r in out.collect()} <= set(rows)
    by_class = C.stratified_split(df, "_class", ["_h", "_rid"], train_percent=50)
    assert by_class.count() == len(rows)


def test_split_does_not_depend_on_the_layout(spark):
    rows = [(k % 40, "x" if k % 4 else None, k % 6) for k in range(2000)] + [(1, "x", 1)] * 700
    df = spark.createDataFrame(rows, "key long, label string, payload long")
    made = [sorted(map(str, C.stratified_split(df.repartition(n), "label", ["key"], train_percent=61).collect())) for n in (1, 9)]
    assert made[0] == made[1] and len(made[0]) == len(rows)
