import zlib

from pyspark.sql import functions as F

from scorewright.llm import rule_quality
from scorewright.llm.catalog import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_no_peeking(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = rule_quality.classify(docs, labels).cache()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in tested) / len(tested) > 0.95
    # other labels on the held-out rows change nothing
    other = labels.withColumn("quality", F.when(rule_quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(
        F.col("quality")))
    again = {r.doc_id: r.score for r in rule_quality.classify(docs, other).collect()}
    assert all(again[r.doc_id] == r.score for r in rows)


def test_rules_as_columns_match_plain_evaluation(spark, hostile):
    model = rule_quality.RuleModel(0.25, [(1.5, (("chars_per_word", True, 4.0), ("distinct_words", False, 0.9))),
                                          (-2.0, (("log_chars", False, 1.0),))])
    stats = rule_quality.statistics(F.col("text"))
    import math

    wide = hostile.select(*(c.alias(k) for k, c in stats.items()))
    for r in wide.withColumn("score", model.score({k: F.col(k) for k in stats})).collect():
        margin = 0.25 + 1.5 * (r.chars_per_word > 4.0 and r.distinct_words <= 0.9) - 2.0 * (r.log_chars <= 1.0)
        assert abs(r.score - 1 / (1 + math.exp(-margin))) < 1e-12


def test_hostile_rows_and_labels(spark, hostile, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1), (4, 0), (None, 1), (9, None), (6, 1), (8, 0), (7, 0)],
                                   "doc_id long, quality int").selectExpr("*", "1 as score", "2 as text")
    out = rule_quality.classify(hostile, labels).collect()
    assert len(out) == hostile.count() and all(r.score is not None and r.held_out is not None for r in out)
    none = labels.where("doc_id = -1")
    assert {r.score for r in rule_quality.classify(hostile, none).collect()} == {0.5}
    ones = rule_quality.classify(hostile, labels.where("quality = 1")).collect()
    assert len({r.score for r in ones}) == 1 and ones[0].score > 0.5
    assert rule_quality.classify(empty, labels).collect() == []


def sample(spark, n=500):
    import numpy as np

    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(n, 3)), 2)
    y = ((x[:, 0] > 0.2) & (x[:, 1] < 0.5) | (x[:, 2] > 1.0)) ^ (rng.random(n) < 0.05)
    return spark.createDataFrame([(*map(float, r), float(c)) for r, c in zip(x, y)], "a double, b double, c double, label double")


def test_paths_are_what_the_trees_do(spark):
    """Of a tree's rules those hold for a row that lead to the nodes it
    passes, and the last of them is where the tree's prediction stands."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rows, names = sample(spark), ["a", "b", "c"]
    data = rows.withColumn("features", array_to_vector(F.array(*names)))
    forest = RandomForestClassifier(numTrees=4, maxDepth=3, seed=3).fit(data)
    for tree in forest.trees:
        root = tree._call_java("rootNode")
        paths = list(rule_quality._paths(root, names))
        for r in data.collect()[:120]:
            node, passed, above = root, [], ()
            while node.getClass().getSimpleName() == "InternalNode":
                i, cut = node.split().featureIndex(), float(node.split().threshold())
                right = r[names[i]] > cut
                above += ((names[i], right, cut),)
                passed.append(above)
                node = node.rightChild() if right else node.leftChild()
            assert tree.predict(r.features) == node.prediction()
            holding = [p for p in paths if all((r[n] > c) == g for n, g, c in p)]
            assert sorted(holding) == sorted(passed)
            for p in holding:
                assert all((r[n] > c) == g for n, g, c in rule_quality._simplify(p))


def test_weights_against_a_plain_optimiser(spark):
    import numpy as np

    rows, penalty = sample(spark), 0.01
    model = rule_quality.fit(rows, trees=4, depth=2, penalty=penalty)
    data = rows.toPandas()
    y = data.label.to_numpy()

    def design(rules):
        hold = [np.logical_and.reduce([(data[n] > c) == g for n, g, c in p]) for p in rules]
        return np.array(hold, dtype=float).T.reshape(len(data), len(rules))

    def loss(bias, w, x):
        m = bias + x @ w
        return np.mean(np.logaddexp(0, m) - y * m) + penalty * np.abs(w).sum()

    # proximal gradient over all rules that the trees of the same fit give
    kept = [p for _, p in model.rules]
    x = design(kept)
    bias, w, step = 0.0, np.zeros(len(kept)), 4.0 / (1 + len(kept))
    for _ in range(20_000):
        gap = 1 / (1 + np.exp(-(bias + x @ w))) - y
        bias -= step * gap.mean()
        w = w - step * x.T @ gap / len(y)
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
    found = loss(model.intercept, np.array([v for v, _ in model.rules]), x)
    assert kept and found <= loss(bias, w, x) + 1e-3


def test_scores_do_not_depend_on_the_layout(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scores = []
    for n in (1, 13):
        scores.append({r.doc_id: r.score for r in rule_quality.classify(docs.repartition(n), labels.repartition(n)).collect()})
    assert all(abs(scores[0][d] - scores[1][d]) < 1e-6 for d in scores[0])


def test_repetition_and_entropy_against_plain_counts(spark, hostile):
    import collections
    import math
    import re

    texts = [r.text for r in hostile.collect()] + ["a b a b a b", "x", "one\ntwo\none\n\n\nthree one", "a a a a", "q w e r t y"]
    stats = rule_quality.statistics(F.col("text"))
    names = ["word_entropy", "repeated_lines", "repeated_trigrams"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", *(stats[n].alias(n) for n in names)).collect()

    def repeated(items):
        return 1 - len(set(items)) / len(items) if items else 0.0

    for r in rows:
        t = texts[r.i] or ""
        words = re.split("[ \t\r\n]+", t)
        counts = collections.Counter(words)
        want = [-sum(c / len(words) * math.log(c / len(words)) for c in counts.values()),
                repeated([x for x in t.split("\n") if x]), repeated(list(zip(words, words[1:], words[2:])))]
        assert all(abs(r[n] - w) < 1e-9 for n, w in zip(names, want)), (t[:40], r, want)
