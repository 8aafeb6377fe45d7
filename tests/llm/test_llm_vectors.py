"""Vantage-point trees and the uniform-threshold search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.llm import topk, vptree

SCHEMA = "vec_id long, embedding array<float>"


def usable(v, zero):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))


def brute(rows, is_query, k, measure, zero):
    rows = [(i, n, np.array(v, dtype=np.float32).astype(float)) for n, (i, v) in enumerate(rows)
            if usable(v, zero)]
    out = []
    for qi, qn, q in rows:
        if qi is not None and is_query(qi):
            found = sorted((measure(q, v), i is None, i or 0, n, i) for i, n, v in rows if n != qn and len(v) == len(q))[:k]
            out += [(qi, r + 1, f[4], f[0]) for r, f in enumerate(found)]
    return sorted(out, key=lambda r: r[:2])


def inner(a, b):
    exact = sum(int(x) * int(y) for x, y in zip(np.floor(256 * a).tolist(), np.floor(256 * b).tolist()))
    return -max(-(1 << 63), min((1 << 63) - 1, exact))


def gap(a, b):
    return float(np.sqrt(((a - b) ** 2).sum()))


def hostile_rows():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(400 + i, [0.5] * 8) for i in range(150)]                     # a hot vector
    rows += [(600, rows[0][1]), (0, rows[0][1]), (700, [0.5] * 8), (700, [0.5] * 8)]  # ties, repeated rows
    rows += [(800, None), (900, [float("nan")] * 8), (1000, [1.0, None] * 4), (1100, [float("inf")] * 8), (1200, [0.0] * 8),
             (1300, []), (1400, [1.0, 2.0]), (1500, [2.0, 1.0]), (1600, [3.0]), (None, [0.1] * 8)]
    # rows without an id: near a query, equal to one, and equal to each other
    rows += [(None, rows[50][1]), (None, rows[100][1]), (None, rows[100][1]), (None, [9.0, -9.0] * 4), (None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rid", "2 as shard", "'x' as vector", "3 as score")


@pytest.mark.parametrize("block", [3, 2048])
def test_top_k_is_exact(spark, block):
    rows = hostile_rows()
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, k=5, shard_size=64, block=block).collect()
    expect = [(q, r, i, -s) for q, r, i, s in brute(rows, lambda i: i % 50 == 0, 5, inner, True)]
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == expect


@pytest.mark.parametrize("lists", [1, 3, 8])
def test_top_k_with_other_lists(spark, lists):
    rows = hostile_rows()[:300]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0, k=7, lists=lists, shard_size=50).collect()
    expect = [(q, r, i, -s) for q, r, i, s in brute(rows, lambda i: i % 100 == 0, 7, inner, True)]
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == expect


def test_top_k_of_large_components(spark):
    rows = [(0, [3e6, -2e6, 1.0]), (1, [3e6, 1e6, 5.0]), (2, [-3e6, 0.0, 2.0])]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") == 0, k=5).collect()
    assert sorted(map(tuple, got)) == [(q, r, i, -s) for q, r, i, s in brute(rows, lambda i: i == 0, 5, inner, True)]


def test_top_k_of_huge_components(spark):
    """One outlier changes nothing for the others, large sums are exact, and
    a score beyond a long stands at its limit."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    rows += [(50, [1e15, 0.0, 1.0]), (51, [0.0, 1e15, 2.0]), (52, [1e30, 1e30, 0.0]), (53, [1e30, -1e30, 1.0]), (54, [-3e38, 3e38, 0.0]),
             (None, [1e16, 2.0, 3.0]), (56, [7e6, 7e6, 7e6]), (57, [9e6, -9e6, 1.0])]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 2 == 0, k=6, shard_size=10, block=7).collect()
    expect = [(q, r, i, -s) for q, r, i, s in brute(rows, lambda i: i % 2 == 0, 6, inner, True)]
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == expect


def test_candidates_grow_slower_than_the_rows(spark):
    rng = np.random.default_rng(4)
    made = {}
    for n in (2_000, 20_000):
        vectors = rng.normal(size=(n, 16)).astype(np.float32)
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA)
        watch = {}
        got = topk.top_k(df, F.col("vec_id") < 20, k=5, shard_size=n // 4, watch=watch).collect()
        whole = np.floor(256 * vectors.astype(float)).astype(np.int64)
        scores = whole[:20] @ whole.T
        scores[np.arange(20), np.arange(20)] = np.iinfo(np.int64).min
        assert sorted((r.query_id, r.rank, r.score) for r in got) == sorted(
            (q, r + 1, int(s)) for q in range(20) for r, s in enumerate(np.sort(scores[q])[::-1][:5]))
        made[n] = watch
    assert made[20_000]["reached"] < 5 * made[2_000]["reached"] and made[20_000]["reached"] < 20 * 20_000 / 10
    assert made[20_000]["looked_up"] <= made[20_000]["reached"]


def test_empty(spark):
    none = frame(spark, hostile_rows()).where("vec_id = -1")
    assert topk.top_k(none, F.col("vec_id") % 50 == 0).collect() == []
    assert vptree.nearest(none, F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("block", [3, 4096])
def test_factor_one_is_exact(spark, block):
    rows = hostile_rows()
    got = vptree.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, k=6, factor=1.0, shard_size=100, leaf=8,
                         block=block).collect()
    expect = brute(rows, lambda i: i % 50 == 0, 6, gap, False)
    got = sorted(map(tuple, got), key=lambda r: r[:2])
    assert [g[:3] for g in got] == [e[:3] for e in expect]
    assert all(abs(g[3] - e[3]) < 1e-12 for g, e in zip(got, expect))


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    truth = brute(rows, lambda i: i % 100 == 0, 10, gap, False)
    got = {(r.query_id, r.vec_id) for r in vptree.nearest(df, F.col("vec_id") % 100 == 0).collect()}
    assert len(got) == len(truth)
    assert len(got & {(q, i) for q, _, i, _ in truth}) / len(truth) >= 0.9


def test_smaller_factors_visit_less():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 0.05, size=(300, 4)) for c in rng.normal(size=(10, 4))])
    order, nodes = vptree.build(points, 16)
    ids = order.copy()
    has = np.ones(len(ids), dtype=bool)
    exact = vptree.search(points[order], ids, has, order, nodes, points[:50], np.arange(50), 5, 1.0)
    d = np.sqrt(((points[:50, None] - points[None]) ** 2).sum(-1))
    d[np.arange(50), np.arange(50)] = np.inf
    assert np.allclose(exact[0], np.sort(d, axis=1)[:, :5])
    loose = vptree.search(points[order], ids, has, order, nodes, points[:50], np.arange(50), 5, 0.0)
    assert (loose[0] >= exact[0] - 1e-12).all()
