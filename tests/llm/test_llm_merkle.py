"""Merkle manifest: against a plain tree in Python and the layout's rules."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, more=0):
    values = (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(level):
    """Levels of a tree from its leaves to the root."""
    out = [level]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def walk(levels, i, digest):
    path = ""
    for level in levels[:-1]:
        run = level[i // 2 * 2:i // 2 * 2 + 2]
        at = i % 2
        path += "".join(run[:at] + run[at + 1:])
        digest = sha("".join(run[:at] + [digest] + run[at + 1:]))
        i //= 2
    return path, digest


def expected(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r.lang is not None, (r.lang or "").encode())].append(r)
    trees = {k: climb([x[1] for x in sorted(((r.doc_id is not None, r.doc_id or 0), leaf_of(r)) for r in groups[k])])
             for k in sorted(groups)}
    top = climb([t[-1][0] for t in trees.values()])
    out = []
    for n, (key, levels) in enumerate(trees.items()):
        ordered = sorted(groups[key], key=lambda r: ((r.doc_id is not None, r.doc_id or 0), leaf_of(r)))
        for i, r in enumerate(ordered):
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            path, h = walk(levels, i, leaf_of(r, 1) if bad else leaf_of(r))
            upper, h = walk(top, n, h)
            out.append((r.doc_id, leaf_of(r), levels[-1][0], top[-1][0], sha(path + upper), h, h == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=str)


@pytest.mark.parametrize("height", [1, 2, 12])
def test_hostile_documents(hostile, height):
    assert got(merkle.audit(hostile, height)) == expected(hostile.collect())


def test_many_layers_and_a_hot_group(spark):
    rows = spark.range(700).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "en").when(F.col("id") % 30 > 0, F.concat(F.lit("x"), F.col("id") % 7)).alias("lang"),
        F.lit("s").alias("source"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("n_chars"), F.repeat(F.lit("é"), (F.col("id") % 4).cast("int")).alias("text"))
    rows = rows.unionByName(rows.where("doc_id < 90"))  # repeated rows
    want = expected(rows.collect())
    assert got(merkle.audit(rows, 2)) == want
    assert {w[6] for w in want} == {True, False}


def test_single_row_and_no_rows(hostile, empty):
    assert got(merkle.audit(hostile.where("doc_id = 9"))) == expected(hostile.where("doc_id = 9").collect())
    out = merkle.audit(empty)
    assert out.collect() == [] and out.columns == merkle.audit(hostile).columns


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 7, 13])
def test_layout_is_a_van_emde_boas_order(levels):
    places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    if levels > 1:  # the upper half comes first, every lower subtree is contiguous
        top = levels // 2
        assert sorted(np.concatenate(places[:top]).tolist()) == list(range((1 << top) - 1))
        for j in range(1 << top):
            below = np.concatenate([p[j << (d - top):(j + 1) << (d - top)] for d, p in enumerate(places) if d >= top])
            assert below.max() - below.min() + 1 == len(below) == (1 << (levels - top)) - 1


def test_stored_siblings_fold_to_the_root():
    leaves = [sha(str(i)) for i in range(13)]
    nodes = merkle.build_block(leaves, 4)
    assert nodes[:32].hex() == climb(leaves)[-1][0]
    for i, path in enumerate(merkle.block_paths(nodes, 13, 4, np.arange(13))):
        assert merkle.fold(leaves[i], path) == nodes[:32].hex() and merkle.fold(sha("x"), path) != nodes[:32].hex()
