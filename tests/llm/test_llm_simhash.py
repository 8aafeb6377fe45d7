import itertools
import re

import numpy as np
import xxhash

from scorewright.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values):
    """Smallest member of the class of each value, by comparing all pairs."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if bin(a ^ b).count("1") <= 2:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def signed(v):
    return v - (1 << 64) if v >= 1 << 63 else v


def test_masks_cover_every_pair_of_positions():
    masks = [m & (1 << 64) - 1 for m in simhash.masks()]
    assert len(masks) == 7
    for a, b in itertools.combinations_with_replacement(range(64), 2):
        assert any(not (m >> a & 1 or m >> b & 1) for m in masks)


def test_components_of_crowded_fingerprints(spark):
    rng = np.random.default_rng(3)
    centers = rng.integers(0, 1 << 63, size=6, dtype=np.uint64)
    values = [int(c) for c in centers]
    for c in centers:
        for _ in range(120):
            value = int(c)
            for bit in rng.integers(0, 64, size=rng.integers(0, 6)):
                value ^= 1 << int(bit)
            values.append(value)
    truth = classes(values)
    df = spark.createDataFrame([(signed(v),) for v in sorted(truth)], "print long")
    found = {r.node & (1 << 64) - 1: r.root for r in simhash.components(simhash.links(df)).collect()}
    groups = {}
    for v, r in truth.items():
        groups.setdefault(r, set()).add(v)
    for members in groups.values():
        if len(members) > 1:
            assert {found[v] for v in members if v in found} == {signed_min(members)}
            assert set(members) - set(found) <= {signed_min(members) & (1 << 64) - 1}
        else:
            assert not members & set(found)


def signed_min(members):
    return min(signed(v) for v in members)


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    root = classes(prints)
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    return [(doc_id, f"{p:016x}", least.get(root[p])) for (doc_id, _), p in zip(rows, prints)]


def test_documents_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == sorted(expected(rows))


def test_hostile_rows(hostile, empty):
    rows = [(r.doc_id, r.text) for r in hostile.collect()]
    got = simhash.near_duplicates(hostile).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected(rows)))
    assert simhash.near_duplicates(empty).collect() == []


def test_one_row_of_each_component_stays(hostile, empty):
    rows = expected([(r.doc_id, r.text) for r in hostile.collect()])
    kept = simhash.keep_one(hostile)
    assert kept.schema == hostile.schema
    # components without an id (here: one text) keep a row too
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for *_, c in rows if c is not None})
    assert len([r for r in kept.collect() if r.doc_id is None]) == len({p for _, p, c in rows if c is None})
    assert simhash.keep_one(empty).collect() == []
