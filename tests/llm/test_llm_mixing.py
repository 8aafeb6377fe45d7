import collections
import math

import pytest
from pyspark.sql import functions as F

from scorewright.llm import mixing


def totals(spark, tokens):
    return mixing.source_totals(spark.createDataFrame([(s, n) for s, n in tokens.items()], "source string, tokens long"))


@pytest.mark.parametrize("ratio", [1.0, 1.5, 2.0, 5.0, 1000.0])
def test_exponent_meets_the_repetition_limit(spark, ratio):
    tokens = {"a": 100_000, "b": 5000, "c": 700}
    x = mixing.bisect_exponent(totals(spark, tokens), max_ratio=ratio)
    closed = max(0.0, 1 - math.log(ratio) / math.log(100_000 / 700))
    assert abs(x - closed) < 1e-9


def test_exponent_meets_the_entropy(spark):
    tokens = {"a": 100_000, "b": 5000, "c": 700}

    def entropy(x):
        raw = [(n / sum(tokens.values())) ** x for n in tokens.values()]
        return -sum(r / sum(raw) * math.log2(r / sum(raw)) for r in raw)

    x = mixing.bisect_exponent(totals(spark, tokens), entropy=1.2)
    assert entropy(x) >= 1.2 > entropy(x + 1e-6)
    with pytest.raises(ValueError):
        mixing.bisect_exponent(totals(spark, tokens))


def corpus(spark):
    rows = [(i, "w " * (1 + i % 9), "big") for i in range(4000)] + [(9000 + i, "w " * (1 + i % 5), f"s{i % 3}") for i in range(600)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_every_row_is_read_and_none_too_often(spark):
    out = mixing.mix(corpus(spark), max_ratio=2.0).toPandas()
    times = collections.Counter(out.doc_id)
    assert len(times) == 4600 and set(times.values()) <= {1, 2}
    share = out.groupby("source").n_tokens.sum() / out.n_tokens.sum()
    weight = out.groupby("source").weight.first()
    assert ((share - weight).abs() < 0.002).all()
    assert not out.duplicated(["doc_id", "epoch"]).any()
    # an epoch reads whole rows from the first blocks of its order
    for (_, epoch), part in out.groupby(["source", "epoch"]):
        assert part.groupby("block").block_rank.nunique().max() == 1


def test_budget(spark):
    out = mixing.mix(corpus(spark), max_ratio=3.0, budget=6000).toPandas()
    assert abs(out.n_tokens.sum() - 6000) < 9 * 4
    assert not out.duplicated(["doc_id", "epoch"]).any()


def test_hostile_rows(hostile, empty):
    out = mixing.mix(hostile).collect()
    src = hostile.collect()
    assert collections.Counter((str(r.doc_id), str(r.source)) for r in out if r.epoch == 0) == collections.Counter(
        (str(r.doc_id), str(r.source)) for r in src)
    full = mixing.mix(hostile, carry=hostile.columns)
    assert full.schema == hostile.schema and full.count() == len(out)
    assert mixing.mix(empty).collect() == []


def test_only_built_in_functions(hostile):
    plan = mixing.mix(hostile)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
