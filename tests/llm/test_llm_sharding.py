import zlib

import numpy as np

from scorewright.llm import sharding


def test_hostile_rows(hostile):
    out = sharding.pack(hostile, n_shards=3).toPandas()
    src = hostile.toPandas()
    assert len(out) == len(src)
    expect = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in src.text)
    assert sorted(zip(out["size"], out.text_crc32)) == expect
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert set(out.law) == {"bytes"} and out.grown_shard.isna().all()


def test_empty(empty):
    assert sharding.pack(empty).collect() == []


def test_hot_group_is_cut_and_level(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(10_000 + i, f"text {i} " * (1 + i % 40)) for i in range(6000)]
    out = sharding.pack(spark.createDataFrame(rows, "doc_id long, text string"), n_shards=8).toPandas()
    sums = out.groupby("shard").agg(size=("size", "sum"), tokens=("tokens", "sum"), rows=("doc_id", "count"))
    assert len(sums) == 8
    assert (sums.max() / sums.mean() < 1.02).all(), sums
    cold = out[out.doc_id >= 10_000]
    assert (cold.groupby("text_crc32").shard.nunique() == 1).all()


def test_group_below_a_shard_stays_together(spark):
    rows = [(i, "twin text") for i in range(300)] + [(1000 + i, f"t{i}") for i in range(3000)]
    out = sharding.pack(spark.createDataFrame(rows, "doc_id long, text string"), n_shards=4).toPandas()
    assert out[out.doc_id < 1000].shard.nunique() == 1


def greedy(vectors, n_shards):
    """Largest first, each where the dot product with what is left is highest."""
    total = [sum(v[m] for v in vectors) / n_shards for m in range(3)]
    scaled = [[v[m] / total[m] if total[m] else v[m] for m in range(3)] for v in vectors]
    left = [[1.0] * 3 for _ in range(n_shards)]
    where = {}
    for i in sorted(range(len(vectors)), key=lambda i: (-max(scaled[i]), i)):
        fits = [sum(a * b for a, b in zip(free, scaled[i])) for free in left]
        where[i] = fits.index(max(fits))
        left[where[i]] = [a - b for a, b in zip(left[where[i]], scaled[i])]
    return [where[i] for i in range(len(vectors))]


def test_place_equals_a_plain_greedy():
    rng = np.random.default_rng(2)
    for n, shards in ((0, 3), (1, 4), (50, 3), (400, 16)):
        vectors = rng.integers(0, 40, size=(n, 3)).astype(float) * 2.0 ** rng.integers(0, 6, size=(n, 1))
        # equal products up to rounding may go either way: none here
        assert sharding.place(vectors, shards).tolist() == greedy(vectors.tolist(), shards)


def test_tokens_are_words(spark):
    texts = ["a  b", " a ", "", None, "one\ttwo\r\nthree", "   ", "x"]
    out = sharding.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), n_shards=2).collect()
    assert {r.doc_id: r.tokens for r in out} == {i: len((t or "").split()) for i, t in enumerate(texts)}


def test_place_levels_every_measure():
    rng = np.random.default_rng(1)
    vectors = rng.exponential(size=(4000, 3))
    shard = sharding.place(vectors, 16)
    sums = np.array([vectors[shard == s].sum(axis=0) for s in range(16)])
    assert (sums.max(axis=0) / sums.mean(axis=0) < 1.01).all()
