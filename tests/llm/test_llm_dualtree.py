"""Dual-tree search: against a plain search over all pairs."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.llm import dualtree

WORDS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def expected(docs, items, k=10):
    """docs, items: (id, text) rows."""
    docs = [(i, words(t)) for i, t in docs]
    docs = [(i, collections.Counter(w), len(w)) for i, w in docs if w]
    big_n, big_l = len(docs), sum(n for _, _, n in docs)
    df = collections.Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        terms, scored = set(words(text)), []
        for doc, tf, n in docs:
            m = 100 - 90 + (90 * n * big_n) // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms if t in tf)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda s: s[:3])
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(scored[:k])]
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(0, "one two, THREE"), (0, "one two, THREE"), (1, None), (None, "alpha text word 漢字 nothere"), (2, ""),
            (3, "!!! ..."), (4, "no id here at all ALL rights reserved"), (5, "unseen words only"), (6, "ﬁ \U0001f600 other")]
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 as rid", "2 as tid", "3 as score", "4 as doc_id")


@pytest.mark.parametrize("k,shard,block", [(10, 1 << 19, 1 << 14), (2, 4, 3), (1, 7, 1 << 14)])
def test_hostile_tables(hostile, items, k, shard, block):
    want = expected([(r.doc_id, r.text) for r in hostile.collect()], [(r.item_id, r.text) for r in items.collect()], k)
    assert got(dualtree.ranked_search(hostile, items, k, shard_postings=shard, block_entries=block)) == want


def test_empty_tables(hostile, empty, items):
    assert got(dualtree.ranked_search(empty, items)) == []
    assert got(dualtree.ranked_search(hostile, items.where("item_id = -1"))) == []


def test_copies_of_a_third_and_ties(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.4, 12) if x < 200) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 - i, texts[3]) for i in range(200)]
    items = [(i, texts[7 * i] + " extra") for i in range(40)]
    df = dualtree.ranked_search(spark.createDataFrame(rows, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"), shard_postings=300, block_entries=60)
    assert got(df) == expected(rows, items)


def test_repartitioned_tables_give_the_same(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = expected([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert got(dualtree.ranked_search(docs, items)) == want
    assert got(dualtree.ranked_search(docs.repartition(7), items, shard_postings=2000, block_entries=100)) == want


def made_search(kind="clustered", k=3, scale=1):
    rng = np.random.default_rng(1)
    n_docs, n_items, width = 1500, 60, 400
    entries, item_entries = set(), set()
    for d in range(n_docs):
        base = (d % 4) * 100
        entries |= {(d, base + int(x)) for x in np.minimum(rng.zipf(1.3, 20), 100) - 1}
    for i in range(n_items):
        base = (i % 4) * 100
        item_entries |= {(i, base + int(x)) for x in np.minimum(rng.zipf(1.3, 8), 100) - 1}
    doc, term = map(np.array, zip(*sorted(entries)))
    item, item_term = map(np.array, zip(*sorted(item_entries)))
    impact, weight = rng.integers(1, 1000, len(doc)) * scale, (rng.integers(1, 9000, width) * scale)[item_term]
    full = np.zeros((n_items, n_docs), dtype=np.int64)
    dense = np.zeros((n_docs, width), dtype=np.int64)
    dense[doc, term] = impact
    weights = np.zeros((n_items, width), dtype=np.int64)
    weights[item, item_term] = weight
    full = weights @ dense.T
    return doc, term, impact, n_docs, item, item_term, weight, n_items, width, full


@pytest.mark.parametrize("scale", [1, 100_000])
def test_pruning_is_exact_and_prunes(scale):
    """Also with sums beyond what doubles hold."""
    *args, full = made_search(scale=scale)
    search = dualtree.ShardSearch(*args, np.zeros(60, dtype=np.int64), 3)
    i, d, s = search.run()
    assert (full[i, d] == s).all() and search.kind == (np.float64 if scale == 1 else np.int64)
    for item in range(60):
        top = np.sort(full[item])[-3:]
        found = set(d[i == item].tolist())
        assert {int(x) for x in np.nonzero(full[item] >= top[0])[0] if full[item, x] > 0} <= found
    assert search.evaluated < full.size / 4 and len(i) == len(set(zip(i.tolist(), d.tolist())))


def test_floor_from_other_shards_prunes_more():
    *args, full = made_search()
    plain = dualtree.ShardSearch(*args, np.zeros(60, dtype=np.int64), 3)
    plain.run()
    floor = np.sort(full, axis=1)[:, -3]
    search = dualtree.ShardSearch(*args, floor, 3)
    i, d, s = search.run()
    assert search.evaluated <= plain.evaluated and (s >= floor[i]).all()
    assert all((i == item).sum() >= 3 for item in range(60))
