"""Merkle manifest of a data set, its subtrees stored in van Emde Boas order.

Every row is a leaf, every group (a language, say) a binary tree over its
leaves in id order, and the roots of the groups are the leaves of one more
tree.  A tree is cut into aligned subtrees of ``HEIGHT`` levels, the blocks;
a block's nodes lie in one byte string in van Emde Boas order: the subtree is
split at half its height, the upper half first, then the lower ones from left
to right, each again in that order.  Where a node lies is arithmetic on its
depth and index, with which blocks are built and siblings are read; a path
from a leaf to the block's root touches few cache lines whatever their size.
The roots of the blocks are the leaves of the next layer of blocks, until one
block holds the rest of the tree.

Every block is one small group of a Spark job.  Ranks come from a range sort
and counts per partition, so that a group with a third of all rows is spread
like any other; the paths above a block go down layer by layer with joins.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewright.llm.common import row_id, ship_package, written

HEIGHT = 12  # levels of edges in a block: 4096 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCKS = "tree string, block bigint, total bigint, nodes binary, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` of a depth (root: 0) in a complete tree
    of that many levels of nodes, laid out in van Emde Boas order."""
    place, index = np.zeros(len(index), dtype=np.int64), np.asarray(index, dtype=np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        levels, depth = levels - top, depth - top
        place += (1 << top) - 1 + (index >> depth) * ((1 << levels) - 1)
        index = index & ((1 << depth) - 1)
    return place


@functools.lru_cache(maxsize=64)
def _addresses(levels: int, depth: int) -> np.ndarray:
    return address(levels, depth, np.arange(1 << depth))


def block_height(total: int, height: int = HEIGHT) -> int:
    """Levels of edges of the blocks of a layer with ``total`` leaves."""
    return (total - 1).bit_length() if total <= 1 << height else height


def build_block(leaves: list[str], height: int) -> bytes:
    """The nodes of one aligned subtree; a node without its right half is
    the digest of the left one alone, places without a node are zero."""
    nodes = np.zeros(((2 << height) - 1, 32), dtype=np.uint8)
    level = leaves
    for depth in range(height, -1, -1):
        raw = np.frombuffer(bytes.fromhex("".join(level)), dtype=np.uint8).reshape(len(level), 32)
        nodes[_addresses(height + 1, depth)[:len(level)]] = raw
        if depth:
            level = [digest("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
    return nodes.tobytes()


def block_paths(nodes: bytes, leaves: int, height: int, wanted: np.ndarray) -> list[list[str]]:
    """Per wanted leaf its steps to the block's root: ``L`` or ``R`` (where
    the sibling stands) and the sibling, or ``-`` where there is none."""
    steps = []
    for k in range(height):
        width = -(-leaves // (1 << k))
        sibling = (wanted >> k) ^ 1
        places = address(height + 1, height - k, sibling).tolist()
        steps.append([("R" if s & 1 else "L") + nodes[32 * p:32 * p + 32].hex() if s < width else "-"
                      for s, p in zip(sibling.tolist(), places)])
    return [list(path) for path in zip(*steps)] if steps else [[] for _ in wanted]


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its steps lead to."""
    for step in path:
        leaf = digest(leaf + step[1:] if step[0] != "L" else step[1:] + leaf)
    return leaf


def proof_digest(path: list[str]) -> str:
    return digest("".join(step[1:] for step in path))


def leaf_digest(fields: dict[str, Column]) -> Column:
    """SHA-256 over the fields, each ``-`` if null, else its UTF-8 length, a
    colon and the value."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0 in every ``tree``) and ``total`` (the
    tree's rows), from a range sort and counts per partition."""
    by = [F.col("tree"), *order, F.col("tie")]
    dealt = rows.withColumn("tie", row_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("tie")
    placed = written(dealt.select("*", F.spark_partition_id().alias("part"), row_id().alias("at")), name)
    counts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part")) - F.col("n")
    shift = counts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("total"))
    return placed.join(shift, ["tree", "part"]).withColumn("rank", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _build(height: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        total, leaves = table["total"][0].as_py(), table["digest"].to_pylist()
        nodes = build_block(leaves, block_height(total, height))
        return pa.table({"tree": [key[0].as_py()], "block": pa.array([key[1].as_py()], pa.int64()),
                         "total": pa.array([total], pa.int64()), "nodes": pa.array([nodes], pa.binary()),
                         "root": [nodes[:32].hex()]})
    return run


def layers(leaves: DataFrame, height: int, name: str) -> list[DataFrame]:
    """The blocks of all trees, layer by layer from the leaves (``tree, rank,
    total, digest``); a tree ends in the layer where one block holds it."""
    most = leaves.agg(F.max("total")).first()[0]
    out = []
    while True:
        blocks = written(leaves.select("tree", F.shiftright("rank", height).alias("block"), "rank", "total", "digest")
                         .groupBy("tree", "block").applyInArrow(_build(height), BLOCKS), f"{name}-{len(out)}")
        out.append(blocks)
        if most <= 1 << height:
            return out
        most = -(-most >> height)
        leaves = blocks.where(F.col("total") > 1 << height).select(
            "tree", F.col("block").alias("rank"), F.shiftright(F.col("total") + ((1 << height) - 1), height).alias("total"),
            F.col("root").alias("digest"))


def ends(stack: list[DataFrame], height: int) -> DataFrame:
    """``tree, root``: the blocks where trees end."""
    last = [b.where(F.col("total") <= 1 << height).select("tree", "root") for b in stack]
    return functools.reduce(DataFrame.unionByName, last)


def _count(total: int, block: int, height: int) -> int:
    return min(1 << height, total - (block << height)) if total > 1 << height else total


def _all_paths(height: int, own: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = _count(r["total"], r["block"], height)
                paths = block_paths(r["nodes"], n, block_height(r["total"], height), np.arange(n))
                for a in range(0, n, 512):
                    part = paths[a:a + 512]
                    ranks = (r["block"] << height) + a + np.arange(len(part))
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array([r["tree"]] * len(part), pa.string()), "rank": pa.array(ranks, pa.int64()),
                        own: pa.array([",".join(p + ([r["above"]] if r["above"] else [])) for p in part], pa.string())})
    return run


def with_above(stack: list[DataFrame], above: DataFrame | None, height: int, name: str) -> DataFrame:
    """The blocks of the first layer with ``above``, the steps from their
    root upwards (joined by commas); ``above`` has ``tree, above`` for the
    roots of the trees, or nothing lies above them."""
    lower = None
    for layer in reversed(range(len(stack))):
        blocks = stack[layer]
        last = blocks.where(F.col("total") <= 1 << height)
        last = last.withColumn("above", F.lit("")) if above is None else last.join(above, "tree")
        if lower is not None:
            inner = blocks.where(F.col("total") > 1 << height).join(
                lower.withColumnRenamed("rank", "block"), ["tree", "block"])
            last = last.unionByName(inner)
        if layer:
            lower = written(last.mapInArrow(_all_paths(height, "above"), "tree string, rank bigint, above string"),
                            f"{name}-paths-{layer}")
    return last


@dataclass
class Manifest:
    """``leaves``: the rows with ``tree, rank, total, digest``; ``stack`` and
    ``top``: the layers of blocks of the groups' trees and of the tree over
    their roots; ``roots``: ``tree, subroot, root, above`` (the steps from a
    subroot to the root)."""

    leaves: DataFrame
    stack: list[DataFrame]
    top: list[DataFrame]
    roots: DataFrame
    height: int


def manifest(rows: DataFrame, order: list[Column], height: int = HEIGHT) -> Manifest:
    """Trees over ``rows`` (``tree`` and ``digest``, with other columns),
    leaves in the given order.  There must be a row."""
    ship_package(rows.sparkSession)
    leaves = written(ranked(rows, order, "merkle-sorted"), "merkle-leaves")
    stack = layers(leaves, height, "merkle")
    subroots = ends(stack, height).withColumnRenamed("root", "digest")
    over = written(ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"),
                          [F.col("of")], "merkle-roots"), "merkle-top-leaves")
    top = layers(over, height, "merkle-top")
    steps = with_above(top, None, height, "merkle-top").mapInArrow(
        _all_paths(height, "above"), "tree string, rank bigint, above string")
    roots = written(over.join(steps, ["tree", "rank"]).join(ends(top, height), "tree").select(
        F.col("of").alias("tree"), F.col("digest").alias("subroot"), "root", "above"), "merkle-all-roots")
    return Manifest(leaves, stack, top, roots, height)


def _prove(height: int, schema: pa.Schema, claim: str):
    def run(_, rows: pa.Table, block: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        (b,) = block.to_pylist()
        n = _count(b["total"], b["block"], height)
        wanted = rows["rank"].to_numpy() - (b["block"] << height)
        above = b["above"].split(",") if b["above"] else []
        paths = [p + above for p in block_paths(b["nodes"], n, block_height(b["total"], height), wanted)]
        folded = [fold(leaf, p) for leaf, p in zip(rows[claim].to_pylist(), paths)]
        values = {"proof_sha256": [proof_digest(p) for p in paths], "folded_root": folded,
                  "verified": [f == b["all_root"] for f in folded], "subroot": [b["subroot"]] * len(paths),
                  "root": [b["all_root"]] * len(paths), "steps": [len(p) for p in paths]}
        return pa.table([pa.array(values[f.name], f.type) if f.name in values else rows[f.name].cast(f.type) for f in schema],
                        schema=schema)
    return run


def prove(made: Manifest, keep: list[str], claim: str = "digest") -> DataFrame:
    """Per leaf the columns ``keep``, ``subroot, root, proof_sha256`` (digest
    of its siblings, level by level up to the root), ``folded_root`` (from
    the leaf digest ``claim`` and the stored siblings), ``verified`` (whether
    that is the root) and ``steps`` (levels from the leaf to the root)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    height = made.height
    blocks = with_above(made.stack, made.roots.select("tree", "above"), height, "merkle").join(
        made.roots.select("tree", "subroot", F.col("root").alias("all_root")), "tree")
    rows = made.leaves.select(*dict.fromkeys([*keep, "tree", "rank", claim]), F.shiftright("rank", height).alias("block"))
    schema = made.leaves.select(*keep).schema
    for name, kind in (("subroot", "string"), ("root", "string"), ("proof_sha256", "string"), ("folded_root", "string"),
                       ("verified", "boolean"), ("steps", "integer")):
        schema = schema.add(name, kind)
    return rows.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        _prove(height, to_arrow_schema(schema), claim), schema)


def audit(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified,
    steps`` of every row of ``docs``: one tree per ``lang``, leaves by
    ``doc_id``, and a check against tampered rows: where 7 divides the crc32
    of the decimal id, one is added to ``n_chars`` and the root is folded
    from that leaf and the original siblings.

    Null languages form the first tree, null ids come first in theirs, rows
    of one id follow by their digest; equal rows are leaves of their own.
    Null ids are not tampered with, nor are null counts changed (they verify).
    Empty and very long texts are fields like others; other columns play no
    part.  An empty table gives an empty result.
    """
    schema = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, steps int"
    fields = {f: F.col(f) for f in FIELDS}
    more = F.col("n_chars").cast("decimal(38,0)") + F.lit(1)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("lang").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("lang").cast("string"))).alias("tree"),
        leaf_digest(fields).alias("digest"),
        F.when(tampered, leaf_digest({**fields, "n_chars": more})).alias("claim"))
    if rows.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    made = manifest(rows.withColumn("claim", F.coalesce("claim", "digest")),
                    [F.col("doc_id").asc_nulls_first(), F.col("digest")], height)
    return prove(made, ["doc_id", "digest"], "claim").withColumnRenamed("digest", "leaf")


def twin_sql() -> str:
    """The audit in DuckDB: node tables by recursion over the levels, then a
    walk from every leaf to the root."""
    fields = " || ".join(f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in FIELDS)
    claim = fields.replace("n_chars::VARCHAR", "(n_chars::HUGEINT + 1)::VARCHAR")
    crc = ("xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT), "
           "lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")
    climb = """SELECT tree, level + 1, idx // 2, sha256(hash || coalesce(next, '')), (n + 1) // 2 FROM
      (SELECT *, lead(hash) OVER (PARTITION BY tree ORDER BY idx) AS next FROM {0} WHERE n > 1) WHERE idx % 2 = 0"""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, sha256({fields}) AS leaf,
    CASE WHEN coalesce({crc} % 7 = 0, false) THEN sha256({claim}) ELSE sha256({fields}) END AS claim FROM documents),
r AS (SELECT *, coalesce('1' || lang, '0') AS tree, row_number() OVER () AS rid,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM d),
t AS (SELECT tree, 0 AS level, idx, leaf AS hash, n FROM r UNION ALL {climb.format('t')}),
s AS (SELECT tree AS lang_tree, hash, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT '' AS tree, 0 AS level, idx, hash, n FROM s UNION ALL {climb.format('u')}),
w AS (SELECT rid, tree, level, idx, n, claim AS h, '' AS path FROM (SELECT *, 0 AS level FROM r)
  UNION ALL SELECT w.rid, w.tree, w.level + 1, w.idx // 2,  (w.n + 1) // 2,
    sha256(CASE WHEN w.idx % 2 = 1 THEN t.hash || w.h ELSE w.h || coalesce(t.hash, '') END), w.path || coalesce(t.hash, '')
  FROM w LEFT JOIN t ON t.tree = w.tree AND t.level = w.level AND t.idx = xor(w.idx, 1) WHERE w.n > 1),
x AS (SELECT w.rid, 0 AS level, s.idx, s.n, w.h, w.path, s.hash AS subroot FROM w JOIN s ON s.lang_tree = w.tree WHERE w.n = 1
  UNION ALL SELECT x.rid, x.level + 1, x.idx // 2, (x.n + 1) // 2,
    sha256(CASE WHEN x.idx % 2 = 1 THEN u.hash || x.h ELSE x.h || coalesce(u.hash, '') END), x.path || coalesce(u.hash, ''), x.subroot
  FROM x LEFT JOIN u ON u.level = x.level AND u.idx = xor(x.idx, 1) WHERE x.n > 1),
h AS (SELECT rid, max(level) AS steps FROM w GROUP BY rid)
SELECT r.doc_id, r.leaf, x.subroot, u.hash AS root, sha256(x.path) AS proof_sha256, x.h AS folded_root, x.h = u.hash AS verified,
  (h.steps + x.level)::INT AS steps
FROM x JOIN r USING (rid) JOIN h USING (rid), (SELECT hash FROM u WHERE n = 1) u WHERE x.n = 1"""
