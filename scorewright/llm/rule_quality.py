"""Quality classifier: a sparse rule ensemble.

Shallow trees are grown on text statistics of a bounded sample of labelled
rows; every path from a root to a node becomes a conjunctive rule; a lasso
logistic regression on the rules keeps a few of them with weights.  The
kept rules are compiled into one Spark column expression, so scoring is a
projection over the documents (no join, no shuffle, no Python).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from scorewright.llm.common import UPPER, row_id, temp_name, written

SAMPLE_ROWS = 20_000
FIT_PARTS = 8
SYMBOLS = "#$%&*"


def word_hashes(text: Column) -> Column:
    """A hash of every word of a text (null: empty), in order."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "[ \\t\\r\\n]+"), lambda w: F.xxhash64(w))


def statistics(text: Column, hashes: Column | None = None) -> dict[str, Column]:
    """The statistics of a whole text that rules may test; all are numbers
    and defined for null and empty texts (read as '').  ``hashes``: a column
    that already has the text's ``word_hashes``."""
    t = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(t), F.lit(1))
    words = word_hashes(text) if hashes is None else hashes
    n_words = F.greatest(F.size(words), F.lit(1))

    def count(ch: str) -> Column:
        return F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))

    symbols = count(SYMBOLS[0])
    for ch in SYMBOLS[1:]:
        symbols = symbols + count(ch)
    upper = F.length(t) - F.length(F.regexp_replace(t, f"[{UPPER}]+", ""))
    lines = F.array_remove(F.split(t, "\n"), "")
    pairs = F.zip_with(words, F.slice(words, 2, n_words), lambda a, b: F.xxhash64(a, b))
    grams = F.zip_with(pairs, F.slice(words, 3, n_words), lambda ab, c: F.xxhash64(ab, c))
    grams = F.slice(grams, F.lit(1), F.greatest(n_words - 2, F.lit(0)))  # without the two that run out of words
    stats = {
        "log_chars": F.log1p(F.length(t)),
        "chars_per_word": F.length(t) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "upper_share": upper / chars,
        "bars_per_word": count("|") / n_words,
        "symbols_per_word": symbols / n_words,
        "shouts_per_word": count("!") / n_words,
        "stops_per_word": count(".") / n_words,
        "lines_per_word": count("\n") / n_words,
        "word_entropy": _entropy(words),
        "repeated_lines": _repeated(lines),
        "repeated_trigrams": _repeated(grams),
    }
    return {k: v.cast("double") for k, v in stats.items()}


def _repeated(items: Column) -> Column:
    """The share of an array's entries that stand in it before; 0 for none."""
    return 1.0 - F.size(F.array_distinct(items)) / F.greatest(F.size(items), F.lit(1)) - F.when(
        F.size(items) == 0, F.lit(1.0)).otherwise(F.lit(0.0))


def _entropy(words: Column) -> Column:
    """Entropy of the words' frequencies in nats: log n less the mean of the
    logarithm of each word's count, by runs of their sorted hashes."""
    none = F.struct(F.lit(None).cast("long").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def weight(run: Column) -> Column:
        return F.when(run > 0, run * F.log(run)).otherwise(F.lit(0.0))

    def step(acc: Column, h: Column) -> Column:
        # the sum over runs of c log c grows by the difference that one more makes
        run = F.when(acc["last"] == h, acc["run"] + 1.0).otherwise(F.lit(1.0))
        return F.struct(h.alias("last"), run.alias("run"), (acc["sum"] + weight(run) - weight(run - 1.0)).alias("sum"))

    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    return F.aggregate(F.sort_array(words), none, step, lambda acc: F.log(n) - acc["sum"] / n)


def with_statistics(docs: DataFrame, text_col: str, names: dict[str, str]) -> DataFrame:
    """``docs`` and its texts' statistics under the given names.  Words are
    cut and hashed once, in a projection below the statistics."""
    hashes = temp_name("hashes")
    wide = docs.withColumn(hashes, word_hashes(F.col(text_col)))
    return wide.withColumns({names[k]: c for k, c in statistics(F.col(text_col), F.col(hashes)).items()}).drop(hashes)


@dataclass
class RuleModel:
    """``rules``: (weight, ((statistic, is_greater, threshold), ...)).
    ``fixed`` is the score where no labels could be learnt from."""

    intercept: float = 0.0
    rules: list = field(default_factory=list)
    fixed: float | None = None

    @property
    def constant(self) -> bool:
        """Whether every text has the same score: nothing was learnt."""
        return self.fixed is not None or not self.rules

    def score(self, stats: dict[str, Column]) -> Column:
        if self.fixed is not None:
            return F.lit(float(self.fixed))
        margin = F.lit(self.intercept)
        for weight, path in self.rules:
            margin = margin + F.when(_holds(path, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-margin))


def _holds(path, stats) -> Column:
    cond = None
    for name, greater, threshold in path:
        test = stats[name] > F.lit(threshold) if greater else stats[name] <= F.lit(threshold)
        cond = test if cond is None else cond & test
    return cond


def _paths(node, names, above=()):
    """All conjunctions from the root to a node below it."""
    if above:
        yield above
    if node.getClass().getSimpleName() != "InternalNode":
        return
    name, cut = names[node.split().featureIndex()], float(node.split().threshold())
    yield from _paths(node.leftChild(), names, above + ((name, False, cut),))
    yield from _paths(node.rightChild(), names, above + ((name, True, cut),))


def _simplify(path) -> tuple:
    """One lower and one upper bound per statistic, in a fixed order."""
    bounds: dict = {}
    for name, greater, cut in path:
        key = (name, greater)
        bounds[key] = cut if key not in bounds else (max if greater else min)(bounds[key], cut)
    return tuple((n, g, c) for (n, g), c in sorted(bounds.items()))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                  learnable: Column | None, sample_rows: int) -> DataFrame:
    """Statistics and label of at most about ``sample_rows`` labelled
    documents, chosen by a hash of the id.  Contradicting labels of one id
    count by their majority; ties and null labels are left out."""
    one = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(F.col(id_col).alias("_label_id")).agg(F.avg(F.col(label_col).cast("double")).alias("_share"))
           .where("_share <> 0.5"))
    if learnable is not None:
        one = one.where(learnable)
    n = one.count()
    slots = 1 << 20
    keep = slots if n <= sample_rows else int(slots * sample_rows / n)
    # proven bound: about sample_rows ids (the share of hash slots kept)
    chosen = F.broadcast(one.where(F.pmod(F.xxhash64("_label_id"), F.lit(slots)) < keep)
                         .select("_label_id", (F.col("_share") > 0.5).cast("double").alias("label")))
    names = list(statistics(F.lit("")))
    joined = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(
        chosen, F.col("_doc") == F.col("_label_id"))
    return written(with_statistics(joined.select("_text", "label"), "_text", {k: k for k in names})
                   .select(*names, "label"), "quality-sample")


def fit(rows: DataFrame, trees: int = 12, depth: int = 3, penalty: float = 0.002, seed: int = 17) -> RuleModel:
    """Grow the trees, read their paths as rules, fit the lasso weights.

    Without rows the score is 0.5 everywhere; with one class only it is the
    smoothed share of that class.  The trees draw their rows per partition, so
    the bounded sample is dealt and ordered by its content first: the model
    does not depend on the layout of the tables.
    """
    names = [c for c in rows.columns if c != "label"]
    content = temp_name("content")
    rows = (rows.withColumn(content, F.xxhash64(*rows.columns)).repartition(FIT_PARTS, content)
            .sortWithinPartitions(content, *rows.columns).drop(content))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        ones, n = counts.get(1.0, 0), sum(counts.values())
        return RuleModel(fixed=(ones + 0.5) / (n + 1.0))
    data = rows.withColumn("features", array_to_vector(F.array(*names)))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, subsamplingRate=0.7,
                                    featureSubsetStrategy="onethird", seed=seed).fit(data)
    found = dict.fromkeys(_simplify(p) for t in forest.trees for p in _paths(t._call_java("rootNode"), names))
    paths = sorted(found)
    if not paths:
        return RuleModel(fixed=(counts[1.0] + 0.5) / (sum(counts.values()) + 1.0))
    columns = {n: F.col(n) for n in names}
    # the rule tests of the bounded sample, written once for the many passes of the lasso
    tests = written(rows.select("label", array_to_vector(F.array(
        *(_holds(p, columns).cast("double") for p in paths))).alias("features")), "quality-rules")
    lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=60).fit(tests)
    weights = lasso.coefficients.toArray().tolist()
    return RuleModel(float(lasso.intercept), [(w, p) for w, p in zip(weights, paths) if w != 0.0])


def held_out(id_col: Column) -> Column:
    """Rows whose labels may never be learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    rows = training_rows(docs, labels, id_col, text_col, label_col, ~held_out(F.col("_label_id")), sample_rows)
    return fit(rows)


def with_score(docs: DataFrame, model: RuleModel, text_col: str, score_col: str) -> DataFrame:
    """Every row and column of ``docs`` plus the score.  The statistics are
    computed once, in a projection below the rules."""
    named = {k: f"__{score_col}_{k}" for k in statistics(F.lit(""))}
    wide = with_statistics(docs, text_col, named)
    return wide.withColumn(score_col, model.score({k: F.col(v) for k, v in named.items()})).drop(*named.values())


def accepted(docs: DataFrame, model: RuleModel, text_col: str, threshold: float) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; all rows if
    the model is a constant, which tells no document from another."""
    if model.constant:
        return docs
    named = {k: temp_name(k) for k in statistics(F.lit(""))}
    row = temp_name("row")
    # A filter moves below a projection of plain expressions and then computes
    # every statistic again for each rule that tests it; the row id, which it
    # mentions too, keeps it above.
    wide = with_statistics(docs, text_col, named).withColumn(row, row_id())
    score = model.score({k: F.col(v) for k, v in named.items()})
    return wide.where((score >= threshold) & (F.col(row) >= 0)).drop(row, *named.values())


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Null and empty texts are scored like any text; a null id is never held
    out; repeated rows and ties each keep their row; an empty input gives an
    empty result.  Labels, language, source and id are not inputs of a score.
    """
    model = train(docs, labels, id_col, text_col, label_col, sample_rows)
    scored = with_score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                        model, "text", "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
